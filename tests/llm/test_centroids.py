"""Centroid clustering against SQL and brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactweave.llm import centroids, registry

VECTORS = "vec_id long, embedding array<float>"


def naive(rows, rounds=10, dims=64, scale=1024, count=8):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:count]
    middle = [v for _, v in seeds]

    def assign():
        out = []
        for _, v in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
            out.append((apart.index(min(apart)), min(apart)))
        return out

    for _ in range(rounds):
        own = [[] for _ in middle]
        for (_, v), (c, _) in zip(kept, assign(), strict=True):
            own[c].append(v)
        middle = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for c, vs in zip(middle, own, strict=True)]
    return sorted(((i is None, i or 0), c, d) for (i, _), (c, d) in zip(kept, assign(), strict=True)), middle


def found(df, **more):
    rows, middle = centroids.cluster(df, **more)
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance) for r in rows.collect()), middle.tolist()


def test_sql(spark, sf, same_as_sql):
    same_as_sql(registry.QUERIES["op13_hilbert_blocks"](spark, sf), registry.ORACLES["op13_hilbert_blocks"])


def test_whole_query_by_definition(spark, sf):
    want, middle = naive([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    got = centroids.op13_hilbert_blocks(spark, sf).collect()
    assert sorted(((False, r.vec_id), r.cluster, r.distance) for r in got) == want
    total = [sum(d for _, c, d in want if c == k) for k in range(8)]
    for r in got:
        assert (r.cluster_inertia, r.inertia, r.centroid_sha256) == (total[r.cluster], sum(total), hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest())


@pytest.mark.parametrize(("kind", "size"), [("spread", 512), ("clustered", 7), ("few", 512), ("equal", 4)])
def test_odd_vectors(spark, kind, size):
    """Ties, repeated rows and ids, vectors that take no part, fewer vectors than centroids, and small blocks."""
    rng = random.Random(size)
    near = [[rng.uniform(-9, 9) for _ in range(3)] for _ in range(5)]
    make = {
        "spread": lambda: [rng.uniform(-1, 1) for _ in range(3)],
        "clustered": lambda: [x + rng.uniform(-0.1, 0.1) for x in rng.choice(near)],
        "few": lambda: [rng.choice([-1.0, 1.0]) for _ in range(3)],
        "equal": lambda: [0.5, -0.25, 0.0],
    }[kind]
    rows = [(rng.choice([None, *range(90)]), make()) for _ in range(5 if kind == "few" else 300)]
    rows += rows[:9] + [(1, None), (2, [1.0, 2.0]), (3, [1.0, None, 2.0]), (4, [1.0, math.nan, 0.0]), (5, [math.inf, 0.0, 0.0]), (6, [])]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"v": F.lit("own"), "place": F.lit(1), "cluster": F.lit(2)}).repartition(4)
    assert found(df, dims=3, size=size, rounds=4) == naive(rows, dims=3, rounds=4)


def test_none_and_too_large(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert found(empty) == ([], []) and found(spark.createDataFrame([(1, None)], VECTORS)) == ([], [])
    with pytest.raises(Exception, match="components must stay below"):
        found(spark.createDataFrame([(1, [1e20])], VECTORS), dims=1)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 2), (2, 1)])
def test_hilbert_curve(dims, bits):
    """All cells once, and each next to the one before."""
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
    places = centroids.hilbert_places(cells, bits)
    assert len(set(places)) == len(cells)
    along = cells[sorted(range(len(cells)), key=places.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_out_no_nearest_centroid():
    rng = np.random.default_rng(4)
    left_out = 0
    for _ in range(500):
        v = rng.integers(-3, 4, (rng.integers(1, 6), 2)) + rng.integers(-9, 9, 2)
        c = rng.integers(-12, 12, (8, 2))
        cluster, distance = centroids.nearest(v, v.min(axis=0), v.max(axis=0), c)
        apart = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        assert (cluster == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
        left_out += 8 - len(centroids.candidates(v.min(axis=0), v.max(axis=0), c))
    assert left_out > 500
