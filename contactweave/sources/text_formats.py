"""FASTA, pairs and allele-table text as DataFrames. Compression goes by the file's suffix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.functions.sequence import record_name, to_int
from contactweave.functions.watch import Watch


def fasta_records(records: DataFrame) -> DataFrame:
    """(place, name, seq) of (place, value), value being a record with or without its ``>``.

    Records without a sequence are dropped.
    """
    parts = F.split(F.regexp_replace("value", "^>", ""), "\n", 2)
    rows = records.select("place", record_name(parts[0]).alias("name"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s+", "").alias("seq"))
    return rows.filter("seq <> ''")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(contig_id, name, seq), ids from 0 in file order.

    A record is a row of its own, so a file is read by many tasks. Ids need the number of
    records in front of each split: records are counted a split, the counts summed up, and
    only they, not the records, are ordered in one place.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.monotonically_increasing_id().alias("place"), "value")
    rows = fasta_records(raw).withColumn("split", F.shiftright("place", 33))
    counts = rows.groupBy("split").agg(F.count("*").alias("n"))
    first = counts.select("split", F.coalesce(F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("split").orderBy("place")) - 1
    return rows.withColumn("k", inside).join(first, "split").select((F.col("first") + F.col("k")).cast("int").alias("contig_id"), "name", "seq")


def parse_pairs(lines: DataFrame) -> DataFrame:
    """(name, pos, next_name, next_pos) of lines (value) with at least eight tab-separated columns that are no comment."""
    cols = F.split("value", "\t")
    rows = lines.filter(~F.col("value").startswith("#") & (F.col("value") != "")).select(cols.alias("c")).filter(F.size("c") >= 8)
    return rows.select(F.col("c")[1].alias("name"), to_int(F.col("c")[2]).alias("pos"), F.col("c")[3].alias("next_name"), to_int(F.col("c")[4]).alias("next_pos"))


def parse_allele_rows(lines: DataFrame, contigs: DataFrame) -> DataFrame:
    """(row_id, contig_ids) of lines (row_id, value): names from the third column on as sorted distinct ids; rows of two or more stay."""
    cols = F.split(F.regexp_replace("value", r"[\r\n]+$", ""), "\t")
    names = lines.select("row_id", cols.alias("c")).filter(F.size("c") >= 4).select("row_id", F.explode(F.expr("slice(c, 3, size(c) - 2)")).alias("name"))
    ids = contigs.groupBy("name").agg(F.min("contig_id").alias("contig_id"))
    found = names.join(ids, "name").groupBy("row_id").agg(F.array_sort(F.collect_set("contig_id")).alias("contig_ids"))
    return found.filter("size(contig_ids) >= 2")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return parse_pairs(spark.read.text(path))


def read_allele_rows(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    return parse_allele_rows(spark.read.text(path).select(F.monotonically_increasing_id().alias("row_id"), "value"), contigs)


def read_mappings(spark: SparkSession, paths: list[str], contigs: DataFrame, windows: DataFrame | None = None, min_mapq: int = 40, check_flags: bool = True, read_length: int = 150, watch: Watch | None = None) -> DataFrame:
    """Filtered read pairs of all files together, each read by its suffix; ``watch`` counts each file's, by the reason they go."""
    from contactweave.operators.reads import bind_names, bind_references, filter_alignments, filter_pairs
    from contactweave.sources import bam

    parts = []
    for path in paths:
        if path.endswith((".pairs", ".pairs.gz")):
            parts.append(filter_pairs(bind_names(read_pairs(spark, path), contigs), windows, read_length, watch, path))
        elif path.endswith(".bam"):
            rows = bam.decoded(spark, path)
            bound = bind_references(bam.alignments(rows), bam.references(rows), contigs)
            parts.append(filter_alignments(bound, windows, min_mapq, check_flags, watch, path))
        else:
            raise ValueError(f"neither .bam nor .pairs: {path}")
    return reduce(DataFrame.unionByName, parts)
