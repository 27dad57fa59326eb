"""Exact top-k inner products by ball trees, shard by shard.

Rows are laid along a Hilbert curve and cut to shards, queries alike to blocks, so both hold
near vectors; each is one stored row with its centre and radius, a shard's with the nodes of
its ball tree, whose halves are halves of the curve. What a block's ball can score with a
shard's at most orders the block's shards. A first wave sends every block to its best two;
from the k-th scores found there, a second wave goes to those of the best sixteen, and a
third to all others, whose bound reaches the least k-th score of the block. A task gets one
shard and one block and walks the tree for the block's queries, the child of the larger upper
bound ``q.centre + |q| * radius`` first; a query leaves a branch whose bound is below its k-th
score so far. Bounds only skip what cannot be among the k, so results are exact. A shard is
copied to the blocks that it may serve, not to all; only centres and radii of all blocks and
shards meet.

Defined cases: vectors that are null, or hold a null or a value that is not finite,
and rows of null id take no part; only vectors of the query's length are its
candidates; rows of equal id are separate rows, and a query skips only itself; ties go
to the smaller id; an empty table gives an empty table. Scores must stay below 2**62.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.llm.centroids import hilbert_places
from contactweave.llm.common import stored, table

SHARD, BLOCK, LEAF = 8192, 2048, 256
#: Shards a block has met after each wave but the last.
WAVES = (2, 16)
#: Copies of the shards' centres.
SALTS = 64
#: Components and bits of a place on the curve.
DIMS, BITS = 64, 4
ROWS = "uid long, vec_id long, v array<long>, width int, place binary"
PACKED = "name long, width int, centre array<double>, radius double, uid array<long>, ids array<long>, v binary, shape binary, centres binary, radii binary"
FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"
#: Below every score.
LEAST = -(1 << 62)


def whole(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, null where the vector takes no part."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale)))


def _places(least: int, most: int):
    """Rows with their place on the curve of the cube from ``least`` to ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, flat = batch.column("width").to_numpy(), batch.column("v").flatten().to_numpy()
            begin, out = np.cumsum(width) - width, [b""] * batch.num_rows
            for w in np.unique(width[width > 0]).tolist():
                at = np.flatnonzero(width == w)
                x = flat[begin[at][:, None] + np.arange(min(w, DIMS))].astype(float)
                cells = np.clip((x - least) / max(1, most - least) * (1 << BITS), 0, (1 << BITS) - 1)
                for k, place in zip(at.tolist(), hilbert_places(cells.astype(np.uint32), BITS), strict=True):
                    out[k] = place
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "vec_id", "v", "width")), pa.array(out, pa.binary())], names=[x.split()[0] for x in ROWS.split(", ")])

    return run


def ball_tree(vectors: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row, behind the last, left and right child) of each node, its centre and its radius; node 0 has all rows."""
    shape, centres, radii = [], [], []

    def node(lo: int, hi: int) -> int:
        own, at = vectors[lo:hi], len(shape)
        centre = own.mean(axis=0)
        shape.append([lo, hi, -1, -1])
        centres.append(centre)
        radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
        if hi - lo > leaf and radii[at] > 0:
            shape[at][2:] = node(lo, (lo + hi) // 2), node((lo + hi) // 2, hi)
        return at

    node(0, len(vectors))
    return np.array(shape, dtype=np.int64), np.array(centres), np.array(radii)


def _packed(size: int, leaf: int):
    """Rows in the curve's order as one row for ``size`` of them and fewer, all of one width."""
    names = [x.split()[0] for x in PACKED.split(", ")]
    types = [pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())] + [pa.binary()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = TaskContext.get().partitionId() << 32, None

        def row(rows: pa.Table) -> pa.RecordBatch:
            width = rows["width"][0].as_py()
            v = rows["v"].combine_chunks().flatten().to_numpy().reshape(len(rows), width)
            shape, centres, radii = ball_tree(v.astype(float), leaf)
            values = (name, width, centres[0].tolist(), radii[0], rows["uid"].to_pylist(), rows["vec_id"].to_pylist(), v.tobytes(), shape.tobytes(), centres.tobytes(), radii.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while held.num_rows:
                width = held["width"].to_numpy()
                same = int(np.argmax(width != width[0])) or len(width)
                if same == len(width) and same < size:
                    break
                yield row(held[: min(same, size)])
                name, held = name + 1, held[min(same, size) :]
        if held is not None and held.num_rows:
            yield row(held)

    return run


def packed(rows: DataFrame, size: int, leaf: int, name: str) -> DataFrame:
    """The rows along the curve, ``size`` a row, stored; a vector that is repeated very often is dealt to many tasks."""
    dealt = rows.repartitionByRange("width", "place", F.xxhash64("uid")).sortWithinPartitions("width", "place", "uid")
    return stored(dealt.mapInArrow(_packed(size, leaf), PACKED), name)


class Best:
    """The k best (score, id) of every query so far; ``floor`` is a score that k candidates are known to reach."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.score, self.id = np.full((queries, k), LEAST), np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        q, c = np.nonzero((scores >= self.floor[at][:, None]) & allowed)
        if not len(q):
            return
        touched = np.unique(q)
        row = np.concatenate([np.repeat(touched, self.k), q])
        score = np.concatenate([self.score[at[touched]].ravel(), scores[q, c]])
        name = np.concatenate([self.id[at[touched]].ravel(), ids[c]])
        order = np.lexsort((name, -score, row))
        first = np.searchsorted(row[order], touched)
        pick = order[first[:, None] + np.arange(self.k)]
        self.score[at[touched]], self.id[at[touched]] = score[pick], name[pick]
        self.floor[at[touched]] = np.maximum(self.floor[at[touched]], self.score[at[touched], -1])


class Shard:
    def __init__(self, row: dict):
        self.width = row["width"]
        self.uid, self.ids = (np.array(row[c], dtype=np.int64) for c in ("uid", "ids"))
        self.v = np.frombuffer(row["v"], dtype=np.int64).reshape(len(self.uid), self.width)
        self.shape = np.frombuffer(row["shape"], dtype=np.int64).reshape(-1, 4)
        self.radii = np.frombuffer(row["radii"])
        self.centres = np.frombuffer(row["centres"]).reshape(len(self.radii), self.width)

    def walk(self, node: int, at: np.ndarray, queries: np.ndarray, size: np.ndarray, own: np.ndarray, vectors: np.ndarray, best: Best) -> None:
        bound = queries[at] @ self.centres[node] + size[at] * self.radii[node]
        at = at[bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 >= best.floor[at]]
        if not len(at):
            return
        lo, hi, *parts = self.shape[node].tolist()
        if parts[0] < 0:
            scores = np.rint(queries[at] @ vectors[lo:hi].T).astype(np.int64)
            best.add(at, scores, self.ids[lo:hi], own[at][:, None] != self.uid[lo:hi][None, :])
            return
        worth = [float((queries[at] @ self.centres[p] + size[at] * self.radii[p]).sum()) for p in parts]
        for k in np.argsort(worth)[::-1]:
            self.walk(parts[k], at, queries, size, own, vectors, best)


def search_task(k: int):
    """The best of one shard (a row) for the queries of one block (a row, with the scores to reach)."""

    def run(shards: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        for row, asked in zip(shards.to_pylist(), blocks.to_pylist(), strict=True):
            shard, block, low = Shard(row), Shard(asked), {x["uid"]: x["low"] for x in asked["lows"] or ()}
            floor = np.array([low.get(u, LEAST) for u in block.uid.tolist()], dtype=np.int64)
            if float(np.abs(shard.v).max(initial=0)) * float(np.abs(block.v).max(initial=0)) * shard.width < 2**53:
                best, queries = Best(len(block.uid), k, floor), block.v.astype(float)
                shard.walk(0, np.arange(len(queries)), queries, np.sqrt((queries**2).sum(axis=1)), block.uid, shard.v.astype(float), best)
                out += [(int(block.uid[q]), int(block.ids[q]), int(best.id[q, n]), int(best.score[q, n])) for q in range(len(queries)) for n in range(k) if best.score[q, n] > LEAST]
            else:  # too large for exact floating point: whole numbers, every row
                plain = list(zip(shard.uid.tolist(), shard.ids.tolist(), shard.v.tolist(), strict=True))
                for u, i, q, least in zip(block.uid.tolist(), block.ids.tolist(), block.v.tolist(), floor.tolist(), strict=True):
                    scored = sorted((-sum(a * b for a, b in zip(q, s, strict=True)), n) for o, n, s in plain if o != u)[:k]
                    out += [(u, i, n, -s) for s, n in scored if -s >= least]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4, names=["query", "query_id", "vec_id", "score"])

    return run


def _wave(shards: DataFrame, blocks: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Every (block, shard) of ``pairs``; only the shards and blocks that it names are copied."""
    left = shards.join(pairs.select("block", "shard"), F.col("name") == F.col("shard"))
    right = blocks.join(pairs.select("block", "shard"), F.col("name") == F.col("block"))
    right = right.toDF(*right.columns)  # both sides come from one table: columns of its own
    return stored(left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(search_task(k), FOUND), "found")


def bounds(blocks: DataFrame, shards: DataFrame) -> DataFrame:
    """(block, shard, bound, place): what a query of a block can score with a row of a shard at most, and the shard's place among the block's; made from centres and radii alone."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    one = blocks.select(F.col("name").alias("block"), "width", F.col("centre").alias("c1"), F.col("radius").alias("r1"), F.sqrt(dot("centre", "centre")).alias("n1"))
    two = shards.select(F.col("name").alias("shard"), "width", F.col("centre").alias("c2"), F.col("radius").alias("r2"), F.sqrt(dot("centre", "centre")).alias("n2"))
    most = dot("c1", "c2") + F.col("n1") * F.col("r2") + F.col("n2") * F.col("r1") + F.col("r1") * F.col("r2")
    # Most vectors have one width: blocks are dealt, and shards' centres copied, to many tasks.
    dealt = F.pmod(F.xxhash64("block"), F.lit(SALTS))
    rows = one.withColumn("salt", dealt.cast("int")).join(two.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["width", "salt"])
    rows = rows.select("block", "shard", most.alias("bound"))
    # Rounding must not make a bound too small.
    rows = rows.withColumn("bound", F.col("bound") + F.abs("bound") * 1e-9 + 1e-6)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy(F.desc("bound"), "shard")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (vec_id, embedding) that are queries."""
    kept = vectors.filter("vec_id IS NOT NULL").select("vec_id", F.coalesce(is_query, F.lit(False)).alias("asked"), whole(F.col("embedding"), scale).alias("v")).filter("v IS NOT NULL")
    rows = stored(kept.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), "v", F.size("v").alias("width"), "asked"), "vectors")
    least, most = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    place = lambda df: df.drop("asked").mapInArrow(_places(least or 0, most or 0), ROWS)
    shards, blocks = packed(place(rows), SHARD, LEAF, "shards"), packed(place(rows.filter("asked")), BLOCK, BLOCK, "blocks")
    member = stored(blocks.select(F.col("name").alias("block"), F.explode("uid").alias("uid")), "members")
    left, found = stored(bounds(blocks, shards), "pairs"), []
    for n, upto in enumerate((*WAVES, None)):
        pairs = left.filter(F.col("place") > WAVES[n - 1]) if n else left
        pairs = pairs if upto is None else pairs.filter(F.col("place") <= upto)
        asked = blocks.withColumn("lows", F.lit(None).cast("array<struct<uid: bigint, low: bigint>>"))
        if found:
            # The k-th score of what was found so far; a query that found fewer starts from the bottom.
            nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
            kth = reduce(DataFrame.unionByName, found).withColumn("n", nth).filter(F.col("n") == k).select(F.col("query").alias("uid"), F.col("score").alias("low"))
            lows = stored(member.join(kth, "uid", "left").groupBy("block").agg(F.min(F.coalesce("low", F.lit(LEAST))).alias("floor"), F.collect_list(F.struct("uid", "low")).alias("lows")), "lows")
            pairs = pairs.join(lows.select("block", "floor"), "block").filter(F.col("bound") >= F.col("floor"))
            asked = blocks.join(lows.select(F.col("block").alias("name"), F.filter("lows", lambda x: x["low"].isNotNull()).alias("lows")), "name")
        found.append(_wave(shards, asked, stored(pairs.select("block", "shard"), "wave"), k))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, 20)


OP9_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::int AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 20
"""
