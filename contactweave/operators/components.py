"""Connected components of an edge table, by alternating star contractions.

Each round points every node at the smallest node it sees (large star: its larger
neighbours; small star: its smaller ones); a logarithmic number of rounds leaves
stars. Rounds are joins and minimum aggregations, so a hub is pre-aggregated and
its edges may be split; each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactweave.functions.storage import stored


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches. Self-links and repeats are harmless."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        last, seen = seen, _state(now)
        if seen == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
