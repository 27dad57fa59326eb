"""The direction of every contig in its sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_sequence(sequence: DataFrame) -> DataFrame:
    """A contig listed in several sequences belongs to the last."""
    return sequence.groupBy("contig_id").agg(F.max_by(F.struct("group_id", "ord"), "group_id").alias("x")).select("x.group_id", "x.ord", "contig_id")


def orientation_costs(reads: DataFrame, sequence: DataFrame, contigs: DataFrame) -> DataFrame:
    """(group_id, ord, contig_id, cost_forward, cost_reversed) from the reads inside one sequence.

    The mate that comes later in the sequence adds its position to the forward cost and the
    rest of its contig to the reversed cost; the earlier mate the other way round.
    """
    place = last_sequence(sequence).join(contigs.select("contig_id", "length"), "contig_id")
    a = place.select(F.col("contig_id").alias("ref_id"), F.col("group_id").alias("ga"), F.col("ord").alias("oa"), F.col("length").cast("long").alias("la"))
    b = place.select(F.col("contig_id").alias("next_ref_id"), F.col("group_id").alias("gb"), F.col("ord").alias("ob"), F.col("length").cast("long").alias("lb"))
    rows = reads.join(a, "ref_id").join(b, "next_ref_id").filter("ga = gb")
    later = F.col("oa") > F.col("ob")
    fa = F.when(later, F.col("pos")).otherwise(F.col("la") - F.col("pos"))
    fb = F.when(later, F.col("lb") - F.col("next_pos")).otherwise(F.col("next_pos"))
    ends = F.array(F.struct(F.col("ref_id").alias("c"), fa.alias("f"), (F.col("la") - fa).alias("r")), F.struct(F.col("next_ref_id").alias("c"), fb.alias("f"), (F.col("lb") - fb).alias("r")))
    sums = rows.select(F.explode(ends).alias("x")).groupBy(F.col("x.c").alias("contig_id")).agg(F.sum("x.f").alias("f"), F.sum("x.r").alias("r"))
    out = place.join(sums, "contig_id", "left")
    return out.select("group_id", "ord", "contig_id", F.coalesce("f", F.lit(0)).cast("double").alias("cost_forward"), F.coalesce("r", F.lit(0)).cast("double").alias("cost_reversed"))


def orient(costs: DataFrame) -> DataFrame:
    """(group_id, ord, contig_id, reversed): reversed only where that costs less."""
    return costs.select("group_id", "ord", "contig_id", (F.col("cost_reversed") < F.col("cost_forward")).alias("reversed"))
