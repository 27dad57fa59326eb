"""Helpers the training-data operators share.

Columns the operators add for their own use start with ``_cw_``; an input
column of the same name as an output column is replaced by the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.functions.storage import shared_dir, stored

__all__ = ["BLANKS", "WORD", "running_total", "shared_dir", "stored", "table", "text_crc32", "word_count"]

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
#: Tasks a small table is dealt to, on any cluster.
DEAL = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table; one of fewer than ``DEAL`` files is dealt to so many tasks, as its few row groups would leave most cores idle. No result depends on it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.repartition(DEAL) if len(df.inputFiles()) < DEAL else df


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_total(df: DataFrame, groups: list[str], bucket: str, order: list, value: str, out: str, *, bounded: bool = False) -> DataFrame:
    """Exclusive running total of ``value`` inside each group, in the order of (bucket, order).

    No task sees a whole group: rows are summed per (group, bucket) with
    map-side combine, the few bucket sums get their own running total, and
    rows are only ordered inside one bucket. ``groups`` and ``bucket`` must
    hold no null. ``bounded``: the number of (group, bucket) pairs is fixed
    by parameters, so their totals may be broadcast.
    """
    keys = [*groups, bucket]
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_cw_sum"))
    base = totals.select(*keys, F.coalesce(F.sum("_cw_sum").over(before), F.lit(0)).alias("_cw_base"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.withColumn("_cw_run", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = ranked.join(F.broadcast(base) if bounded else base, keys)
    return joined.withColumn(out, F.col("_cw_base") + F.col("_cw_run")).drop("_cw_base", "_cw_run")
