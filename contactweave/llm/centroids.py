"""Centroid clustering in whole numbers, over zone maps along a space-filling curve.

Vectors become whole numbers and are laid along a Hilbert curve: near places on the curve
are near in space, so cutting the curve gives blocks of near vectors. A block is one row,
its vectors as a matrix beside the least and largest value of each component (its box),
stored once. In every round a block's box bounds its vectors' squared distance to each
centroid from both sides; only centroids whose lower bound doesn't exceed the least upper
bound are candidates, and the block's vectors are compared with these exactly, all at once.
Bounds and distances are whole numbers, so a centroid that is left out can't win or tie.

A round is one job: tasks add up their blocks, and counts and sums a centroid, k times
dimensions numbers, come to the driver, which forms the next centroids. The curve is dealt
to tasks by ranges of (place, id), so a vector that is repeated very often is split too.

Defined cases: a vector that is null, has another number of components than asked for, or
holds null or a value that isn't finite takes no part; fewer vectors than centroids give as
many centroids; rows of one id are separate rows, equal hashes ordered by the vector; the
hash of a null id is that of an empty one; without vectors there are no rows. Components
must stay below 2**27 after scaling, an error otherwise: distances then fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactweave.llm.common import stored, table

SCALE, DIMS, CENTROIDS, ROUNDS = 1024, 64, 8, 10
#: Bits a component of a place on the curve; vectors in a block.
BITS, BLOCK = 4, 512
LARGEST = 1 << 27
PLACED = "vec_id long, place binary, v binary"
BLOCKS = "ids binary, known binary, v binary, low binary, high binary"


def hilbert_places(x: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of points (rows) with components below ``2**bits``, as bytes in the curve's order.

    The published transform between axes and the transposed index: undo the excess work bit by bit, then Gray-encode.
    """
    x = x.astype(np.uint32)
    n, dims = x.shape
    for bit in range(bits - 1, 0, -1):
        q, low = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for k in range(dims):
            turned = (x[:, k] & q) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, k]) & low).astype(np.uint32)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, k] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=1)
    last = np.zeros(n, dtype=np.uint32)
    for bit in range(bits - 1, 0, -1):
        last ^= np.where((x[:, -1] >> np.uint32(bit)) & 1, (1 << bit) - 1, 0).astype(np.uint32)
    x ^= last[:, None]
    planes = [(x >> np.uint32(bit)) & 1 for bit in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)]


def _place(dims: int, least: int, most: int, bits: int):
    """Rows with their place on the curve of the cube from ``least`` to ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(-1, dims)
            if v.size and np.abs(v).max() >= LARGEST:
                raise ValueError(f"components must stay below {LARGEST} after scaling")
            cells = (v - least) * ((1 << bits) - 1) // max(1, most - least)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(hilbert_places(cells, bits), pa.binary()), pa.array([r.tobytes() for r in v], pa.binary())], names=["vec_id", "place", "v"])

    return run


def _blocks(dims: int, size: int):
    """Rows in the curve's order as blocks with their boxes."""

    def row(ids: pa.Array, raw: bytes) -> pa.RecordBatch:
        v = np.frombuffer(raw, dtype=np.int64).reshape(-1, dims)
        known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
        values = (ids.fill_null(0).to_numpy().tobytes(), known, raw, v.min(axis=0).tobytes(), v.max(axis=0).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in values], names=[x.split()[0] for x in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while held.num_rows >= size:
                yield row(held["vec_id"][:size].combine_chunks(), b"".join(held["v"][:size].to_pylist()))
                held = held[size:]
        if held is not None and held.num_rows:
            yield row(held["vec_id"].combine_chunks(), b"".join(held["v"].to_pylist()))

    return run


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector in the box."""
    below, above = low - centroids, centroids - high
    inside = np.maximum(np.maximum(below, above), 0)
    across = np.maximum(-below, -above)
    return np.flatnonzero((inside**2).sum(axis=1) <= (across**2).sum(axis=1).min())


def nearest(v: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector of a block, the smaller number on ties, and the squared distance."""
    able = candidates(low, high, centroids)
    apart = np.stack([np.einsum("ij,ij->i", d, d) for d in (v - centroids[c] for c in able.tolist())])
    best = apart.argmin(axis=0)
    return able[best], apart[best, np.arange(len(v))]


def _read(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    for batch in batches:
        for ids, known, *rest in zip(*(batch.column(x.split()[0]).to_pylist() for x in BLOCKS.split(", ")), strict=True):
            v, low, high = (np.frombuffer(x, dtype=np.int64) for x in rest)
            yield np.frombuffer(ids, dtype=np.int64), np.frombuffer(known, dtype=bool), v.reshape(-1, dims), low, high


def _sums(centroids: np.ndarray):
    """(cluster, dim, total) of a task's vectors; dim -1 counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, _, v, low, high in _read(batches, dims):
            cluster, _ = nearest(v, low, high, centroids)
            for c in np.unique(cluster).tolist():
                own = v[cluster == c]
                total[c] += own.sum(axis=0)
                count[c] += len(own)
        if count.any():
            at = np.flatnonzero(count)
            values = np.column_stack([count[at], total[at]])
            columns = [np.repeat(at, dims + 1), np.tile(np.arange(-1, dims), len(at)), values.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cluster", "dim", "total"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, known, v, low, high in _read(batches, centroids.shape[1]):
            cluster, distance = nearest(v, low, high, centroids)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=~known), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def blocks_of(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, bits: int = BITS, size: int = BLOCK, count: int = CENTROIDS) -> tuple[DataFrame, np.ndarray]:
    """The stored blocks of (vec_id, embedding), and the first centroids: the vectors of the ``count`` smallest hashes of their ids."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    # The size is asked first, so that a null vector isn't looked into.
    kept = vectors.filter(F.coalesce(F.size("embedding") == dims, F.lit(False)) & fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    kept = stored(kept, "vectors")
    least, most = kept.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    name = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(name, "v").limit(count).select("v").collect()
    placed = stored(kept.mapInArrow(_place(dims, least or 0, most or 0, bits), PLACED), "placed")
    dealt = placed.repartitionByRange("place", F.xxhash64("vec_id")).sortWithinPartitions("place", "vec_id")
    return stored(dealt.mapInArrow(_blocks(dims, size), BLOCKS), "blocks"), np.array([r.v for r in first], dtype=np.int64).reshape(-1, dims)


def next_centroids(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of the mean of each centroid's vectors; one without vectors stays."""
    sums = blocks.mapInArrow(_sums(centroids), "cluster int, dim int, total long").groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {(r.cluster, r.dim): int(r.total) for r in sums.collect()}  # k * (dims + 1) rows
    out = centroids.copy()
    for (c, dim), total in found.items():
        if dim >= 0:
            out[c, dim] = total // found[c, -1]
    return out


def cluster(vectors: DataFrame, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, count: int = CENTROIDS, bits: int = BITS, size: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the last centroids."""
    blocks, centroids = blocks_of(vectors, dims, scale, bits, size, count)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(blocks, centroids)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    return stored(blocks.mapInArrow(_assigned(centroids), schema), "assigned"), centroids


def op13_hilbert_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    sums = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    if sum(sums.values()) >= 1 << 63:
        raise ValueError("the inertia exceeds 64 bits")
    known = [(c, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, total in sums.items()]
    names = spark.createDataFrame(known, "cluster int, cluster_inertia long, centroid_sha256 string")  # a row a centroid
    return rows.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("long").alias("inertia"), "centroid_sha256")


def _sql() -> str:
    """The rounds written out one after the other."""
    apart = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [f"""k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) AS v FROM embeddings
        WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS i, v AS c FROM (SELECT sha256('3:' || coalesce(vec_id::varchar, '')) AS h, v FROM k) QUALIFY i < {CENTROIDS})"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, arg_min(i, (d, i)) AS i, min(d) AS d FROM (SELECT r, i, {apart}::bigint AS d FROM k CROSS JOIN c{n}) GROUP BY r)""")
        if n < ROUNDS:
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT i, coalesce(m, c) AS c FROM c{n} LEFT JOIN (SELECT i, list((s - ((s % n) + n) % n) // n ORDER BY j)::bigint[] AS m FROM (
                SELECT i, j, sum(x) AS s, count(*) AS n FROM (SELECT i, unnest(v) AS x, unnest(range({DIMS})) AS j FROM a{n} JOIN k USING (r)) GROUP BY i, j) GROUP BY i) USING (i))""")
    return f"""WITH {", ".join(steps)} SELECT vec_id, i::int AS cluster, d AS distance, (sum(d) OVER (PARTITION BY i))::bigint AS cluster_inertia, (sum(d) OVER ())::bigint AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{ROUNDS} JOIN k USING (r) JOIN c{ROUNDS} USING (i)"""


OP13_SQL = _sql()
