"""Packed id matrices by best-fit decreasing.

Documents are dealt to buckets by a hash of id and text, as many as the number of rows asks
for. Each bucket's documents, in the order of (doc_id, text hash), are cut at the window and
their pieces pooled, a bounded number of tokens at a time. A pool's pieces go, longest first, to the open row with the least
room that still takes them; a segment tree over the capacities finds that row in
logarithmic time. Rows come out as fixed-width little-endian 32-bit ids, the running
segment lengths, and positions that start again at 0 with every segment.

So which documents share a row depends on the documents alone, not on files, splits or cores.

Defined cases: a null text counts as empty and is one token (the end id); repeated
rows are packed separately; a very long text is tokenised whole and cut into pieces, as
many pools as it takes; pieces of one length go in the order they come, and of rows with
equal room the last opened takes the piece; an empty table gives no rows. Of the input
only doc_id (as a long) and text are read: further columns, also clashing ones, don't
appear in the rows. Reading the pieces of a document in the order of their starts gives
its ids back without loss.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactweave.llm.common import table
from contactweave.llm.tokens import VOCABULARY, document_ids

WINDOW = 1024
POOL = 1 << 21
#: Documents a bucket gets on average.
BUCKET = 1024
ROWS = "bucket int, number long, doc_ids array<long>, starts array<long>, cu_lengths array<int>, n_tokens int, ids binary, positions binary"


class Rooms:
    """Open rows by their room, under a segment tree that counts them."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def _add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += n
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the least room that is enough."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], window: int) -> list[list[int]]:
    """The pieces of each row, as indices into ``lengths``."""
    rooms, rows = Rooms(window), []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = rooms.take(lengths[k])
        if found is None:
            found = window, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(k)
        if room > lengths[k]:
            rooms.put(room - lengths[k], row)
    return rows


def _packed(bucket: int, first: int, pool: list[tuple[int, int, np.ndarray]], window: int) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(8)]
    for n, row in enumerate(best_fit([len(p[2]) for p in pool], window)):
        parts = [pool[k] for k in row]
        cuts = np.cumsum([0] + [len(p[2]) for p in parts])
        ids, positions = np.zeros(window, dtype="<u4"), np.zeros(window, dtype="<u4")
        for (_, _, x), at in zip(parts, cuts, strict=False):
            ids[at : at + len(x)] = x
            positions[at : at + len(x)] = np.arange(len(x))
        values = (bucket, first + n, [p[0] for p in parts], [p[1] for p in parts], cuts.tolist(), int(cuts[-1]), ids.tobytes(), positions.tobytes())
        for c, v in zip(cols, values, strict=True):
            c.append(v)
    types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in ROWS.split(", ")])


def matrices(df: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, pool_tokens: int = POOL, per_bucket: int = BUCKET) -> DataFrame:
    """Rows of the packed matrices of (doc_id, text); (bucket, number) names a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, pool, held = None, 0, [], 0
        for batch in batches:
            for bucket, doc, text in zip(*(batch.column(c) for c in ("bucket", "doc_id", "text")), strict=True):
                if bucket.as_py() != now:
                    if pool:
                        yield _packed(now, first, pool, window)
                    now, first, pool, held = bucket.as_py(), 0, [], 0
                ids = document_ids(text.as_py(), vocabulary)
                for at in range(0, len(ids), window):
                    pool.append((doc.as_py(), at, ids[at : at + window]))
                    held += len(pool[-1][2])
                    if held >= pool_tokens:
                        yield (out := _packed(now, first, pool, window))
                        first, pool, held = first + out.num_rows, [], 0
        if pool:
            yield _packed(now, first, pool, window)

    buckets = max(1, math.ceil(df.count() / per_bucket))
    own = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = own.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")).repartition("bucket")
    return dealt.sortWithinPartitions("bucket", "doc_id", F.xxhash64("text")).mapInArrow(run, ROWS)


def write_matrices(rows: DataFrame, path: str) -> None:
    """One Parquet row a matrix row: ids and positions as fixed-width binary, the lengths beside them."""
    rows.write.parquet(path)


def op7_best_fit_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matrices(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("bucket", "number", "doc_ids", "starts", "cu_lengths", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"))
