"""Packing by non-negative least squares on the length histogram.

Documents are cut at the window; full pieces are sequences of their own. The rest
fall into length classes, and the histogram over these, of fixed size at any input,
is all that the driver sees. There every combination of at most three classes that
fills the window is a column; non-negative least squares finds how often to repeat
each, whole repeats are taken, and what is left is packed greedily, largest class
first, on the histogram too. Pieces are then numbered inside their class by running
totals, and the number says which repeat of which combination takes the piece.

Defined cases: a null text counts as empty and is one token (the end id); repeated
rows are packed separately; an empty table gives no pieces; a class that holds most
pieces is numbered in many buckets; pieces equal in every column are interchangeable,
other ties go by (doc_id, start, CRC of the ids); very long texts are tokenised whole, and
their pieces are rows of their own. Of the input only doc_id (as a long) and text are
read: further columns, also clashing ones, don't appear in the pieces, which carry doc_id
to join by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.llm.common import running_total, stored, table
from contactweave.llm.tokens import VOCABULARY, document_ids

WINDOW = 1024
GRAIN = 8
#: Pieces of a class are numbered inside buckets, at least so many, each of about so many pieces;
#: tables of up to so many bucket sizes are broadcast.
BUCKETS, BUCKET_PIECES, BROADCAST = 256, 1 << 16, 1 << 17
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(df: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """The documents' pieces of at most ``window`` tokens: all full but each document's last. ``with_ids``: their ids too, little-endian 32 bit."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = document_ids(text.as_py(), vocabulary)
                for at in range(0, len(ids), window):
                    raw = ids[at : at + window].tobytes()
                    for col, x in zip(cols, (doc, at, len(raw) // 4, zlib.crc32(raw), len(ids), raw if with_ids else None), strict=True):
                        col.append(x)
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + ([pa.array(cols[5], pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def combinations(classes: int) -> list[tuple[int, ...]]:
    """All multisets of two or three classes that add up to the window."""
    two = [(a, classes - a) for a in range(classes - 1, 0, -1) if a >= classes - a]
    three = [(a, b, classes - a - b) for a in range(classes - 2, 0, -1) for b in range(min(a, classes - a - 1), 0, -1) if b >= classes - a - b]
    return two + three


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """x >= 0 that makes |ax - b| least, by an active set: the column that helps most joins, those driven below zero leave."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    gram, aim = a.T @ a + 1e-9 * np.eye(a.shape[1]), a.T @ b
    eps = 1e-7 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        gain = aim - gram @ x
        gain[used] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= eps:
            break
        used[best] = True
        while True:
            s = np.zeros_like(x)
            s[used] = np.linalg.solve(gram[np.ix_(used, used)], aim[used])
            low = used & (s <= eps)
            if not low.any():
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x = x + step * (s - x)
            used &= ~(low & (x <= eps))
            x[~used] = 0
            if not used.any():
                break
        x = s if used.any() else np.zeros_like(x)
    return x


def plan(histogram: dict[int, int], classes: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination of classes, repeats), using every piece of the histogram once; combinations never exceed ``classes``."""
    left = {c: n for c, n in histogram.items() if n > 0}
    out = [((classes,), left.pop(classes))] if classes in left else []
    combos = combinations(classes)
    if left and combos:
        a = np.zeros((classes, len(combos)))
        for j, combo in enumerate(combos):
            for c in combo:
                a[c, j] += 1
        b = np.array([left.get(c, 0) for c in range(classes)], dtype=float)
        x = nnls(a, b)
        for j in np.argsort(-x, kind="stable"):
            need = {c: combos[j].count(c) for c in combos[j]}
            take = min(int(np.floor(x[j] + 1e-6)), *(left.get(c, 0) // k for c, k in need.items()))
            if take > 0:
                out.append((combos[j], take))
                for c, k in need.items():
                    left[c] -= k * take
    left = {c: n for c, n in left.items() if n}
    while left:
        combo, room, rest = [], classes, dict(left)
        while fit := max((c for c, n in rest.items() if n and c <= room), default=0):
            combo.append(fit)
            room -= fit
            rest[fit] -= 1
        times = min(left[c] // combo.count(c) for c in combo)
        out.append((tuple(combo), times))
        left = {c: n - combo.count(c) * times for c, n in left.items()}
        left = {c: n for c, n in left.items() if n}
    return out


def places(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each class: first number of each stretch, the sequence that number goes to, its place there. Sequences count on by one in a stretch."""
    stretches: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for combo, times in packed:
        for place, c in enumerate(combo):
            stretches.setdefault(c, []).append((taken.get(c, 0), first, place))
            taken[c] = taken.get(c, 0) + times
        first += times
    return {c: tuple(np.array(x, dtype=np.int64) for x in zip(*s, strict=True)) for c, s in stretches.items()}


def pack(pieces: DataFrame, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``."""
    classes = window // grain
    rows = pieces.withColumns({"_cw_class": F.ceil(F.col("length") / grain).cast("int"), "_cw_one": F.lit(1).cast("long")})
    histogram = dict(rows.groupBy("_cw_class").count().collect())  # at most ``classes`` rows
    buckets = max(BUCKETS, -(-max(histogram.values(), default=0) // BUCKET_PIECES))
    rows = rows.withColumn("_cw_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    where = places(plan(histogram, classes))

    @F.arrow_udf("struct<sequence_id: long, place: long>")
    def placed(kinds: pa.Array, numbers: pa.Array) -> pa.Array:
        kind, number = kinds.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False)
        sequence, place = np.zeros(len(kind), dtype=np.int64), np.zeros(len(kind), dtype=np.int64)
        for c in np.unique(kind).tolist():
            at = kind == c
            first, goes, spot = where[c]
            k = np.searchsorted(first, number[at], side="right") - 1
            sequence[at], place[at] = goes[k] + number[at] - first[k], spot[k]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(place)], names=["sequence_id", "place"])

    order = ["doc_id", "start", "ids_crc32"]
    ranked = running_total(rows, ["_cw_class"], "_cw_bucket", order, "_cw_one", "_cw_rank", bounded=classes * buckets <= BROADCAST)
    out = ranked.withColumn("_cw_at", placed("_cw_class", "_cw_rank")).withColumn("sequence_id", F.col("_cw_at.sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy("_cw_at.place").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    return out.select(*[c for c in pieces.columns if c not in ("sequence_id", "offset")], "sequence_id", "offset")


def pack_documents(df: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    return pack(stored(cut_pieces(df, window, vocabulary, with_ids), "pieces"), window)


def op8_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
