"""Positions and running totals over one global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactweave.functions.storage import stored


def ranked(df: DataFrame, order: list[Column], total: str, n: str = "n", out: str = "running") -> DataFrame:
    """``df`` with each row's number from 1 in the order, and the sum of ``total`` up to and with the row.

    Rows are dealt by ranges of the order and sorted there; the ranges' counts and sums are
    few, and only they are added up in one place. Stored, as ranges are cut by sampling.
    """
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_cw_place", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_cw_part", F.shiftright("_cw_place", 33))
    before = Window.orderBy("_cw_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_cw_part").agg(F.count("*").alias("k"), F.sum(total).alias("t"))
    parts = parts.select("_cw_part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("_cw_k"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("_cw_t"))
    inside = Window.partitionBy("_cw_part").orderBy("_cw_place")
    rows = placed.withColumns({n: F.row_number().over(inside), out: F.sum(total).over(inside.rowsBetween(Window.unboundedPreceding, 0))}).join(parts, "_cw_part")
    return rows.withColumns({n: (F.col(n) + F.col("_cw_k")).cast("int"), out: F.col(out) + F.col("_cw_t")}).drop("_cw_place", "_cw_part", "_cw_k", "_cw_t")
