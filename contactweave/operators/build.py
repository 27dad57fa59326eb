"""Scaffolds: AGP layout and sequences of directed chromosomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactweave.functions.sequence import reverse_complement
from contactweave.operators.sites import as_chunks
from contactweave.sources.chunks import own_bases

GAP = 100


def agp(chromosomes: DataFrame, contigs: DataFrame) -> DataFrame:
    """One row a component and one a gap between components, with running 1-based offsets and part numbers."""
    rows = chromosomes.join(contigs.select("contig_id", "name", "length"), "contig_id")
    order = Window.partitionBy("group_id").orderBy("ord")
    before = F.coalesce(F.sum(F.col("length").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    k = F.row_number().over(order)
    rows = rows.withColumn("k", k).withColumn("at", before + GAP * (k - 1)).withColumn("object", F.concat(F.lit("Group_"), F.col("group_id")))
    sign = F.when(F.col("reversed"), "-").otherwise("+")
    part = F.struct(
        (F.col("at") + 1).alias("object_beg"), (F.col("at") + F.col("length")).alias("object_end"), (2 * F.col("k") - 1).alias("part_number"), F.lit("W").alias("component_type"),
        F.col("name").alias("component_id"), F.lit("1").alias("component_beg"), F.col("length").cast("string").alias("component_end"), sign.alias("orientation"))
    gap = F.struct(
        (F.col("at") + 1 - GAP).alias("object_beg"), F.col("at").alias("object_end"), (2 * F.col("k") - 2).alias("part_number"), F.lit("U").alias("component_type"),
        F.lit(str(GAP)).alias("component_id"), F.lit("contig").alias("component_beg"), F.lit("yes").alias("component_end"), F.lit("map").alias("orientation"))
    both = F.when(F.col("k") > 1, F.array(gap, part)).otherwise(F.array(part))
    return rows.select("object", F.explode(both).alias("x")).select("object", "x.*")


def scaffold_pieces(chromosomes: DataFrame, sequences: DataFrame, gap: int = 0) -> DataFrame:
    """(object, ord, part, seq): a row a chunk of a contig in the scaffold's order, reversed contigs complemented, ``gap`` Ns in front of all contigs but a scaffold's first.

    No row grows with its scaffold or its contig.
    """
    chunks = own_bases(as_chunks(sequences)).select("contig_id", "chunk", "seq")
    rows = chromosomes.join(chunks, "contig_id")
    seq = F.when(F.col("reversed"), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    part = F.when(F.col("reversed"), -F.col("chunk")).otherwise(F.col("chunk"))
    rows = rows.select(F.concat(F.lit("Group_"), F.col("group_id")).alias("object"), "ord", part.alias("part"), seq.alias("seq"))
    if not gap:
        return rows
    ends = rows.groupBy("object", "ord").agg(F.min("part").alias("part"))
    ends = ends.withColumn("inner", F.lag("ord").over(Window.partitionBy("object").orderBy("ord")).isNotNull())
    rows = rows.join(ends, ["object", "ord", "part"], "left")
    return rows.select("object", "ord", "part", F.when(F.col("inner"), F.concat(F.lit("N" * gap), "seq")).otherwise(F.col("seq")).alias("seq"))


#: Contigs in a row that are joined before a scaffold is.
RUN = 64


def scaffold_sequences(chromosomes: DataFrame, sequences: DataFrame, gap: int = 0) -> DataFrame:
    """(object, seq): the pieces of each scaffold joined to one string, for scaffolds that fit a row (2 GB); ``scaffold_pieces`` has no such limit.

    Runs of contigs are joined first, so the last step holds a few long strings and no row a piece.
    """
    joined = lambda keys: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*keys, "seq"))), lambda x: x["seq"]), "").alias("seq")
    pieces = scaffold_pieces(chromosomes, sequences, gap).withColumn("run", F.floor(F.col("ord") / RUN))
    return pieces.groupBy("object", "run").agg(joined(["ord", "part"])).groupBy("object").agg(joined(["run"])).select("object", "seq")
