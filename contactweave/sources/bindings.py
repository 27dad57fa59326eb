"""Contact-graph tables derived from the star-schema tables, for queries and tests.

Suppliers stand for contigs, and pairs of line items of one order for read pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "lineitem"), F.col("s_suppkey") == F.col("l_suppkey"))
    counts = rows.groupBy("s_suppkey", "s_name").agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("parts"))
    return counts.select(
        F.col("s_suppkey").cast("int").alias("contig_id"), F.col("s_name").alias("name"), (F.col("n") * 1000).cast("int").alias("length"), (F.col("parts") + 1).cast("int").alias("re_count"))


#: Items that one task pairs, so that its memory doesn't grow with the table.
ITEMS = 250_000


def _mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of items of one order. Items get their contig's length before they meet, so pairs, which are more, are not joined again; both sides are one shuffle."""
    size = contigs(spark, sf_dir).select(F.col("contig_id").alias("l_suppkey"), "length")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    items = items.join(size, "l_suppkey").repartition(items.count() // ITEMS + 1, "l_orderkey")
    side = lambda k: items.select("l_orderkey", F.col("l_linenumber").alias(f"n{k}"), F.col("l_suppkey").alias(f"s{k}"), F.col("length").alias(f"len{k}"))
    rows = side(1).join(side(2), "l_orderkey").filter("n1 < n2 AND s1 <> s2")
    return rows.select(
        F.col("s1").cast("int").alias("ref_id"), F.expr("CAST((l_orderkey * 7919 + n1 * 104729L) % len1 AS INT)").alias("pos"),
        F.col("s2").cast("int").alias("next_ref_id"), F.expr("CAST((l_orderkey * 6101 + n2 * 15485863L) % len2 AS INT)").alias("next_pos"),
        F.expr("CAST((l_orderkey * 31 + n1) % 61 AS SMALLINT)").alias("mapq"),
        F.expr("CASE WHEN l_orderkey % 17 = 0 THEN 1024 WHEN l_orderkey % 23 = 0 THEN 256 ELSE 0 END").alias("flag"), F.lit(150).alias("l_seq"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mates(spark, sf_dir).select("ref_id", "pos", "next_ref_id", "next_pos")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mates(spark, sf_dir)


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("int").alias("contig_id"), F.upper(F.regexp_replace("text", "[^ACGTacgt]", "")).alias("seq"))


def allele_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("c"), "s_nationkey")
    keyed = s.select("c", F.explode(F.array(F.col("s_nationkey").cast("int"), (1000 + F.col("c") % 7).cast("int"))).alias("row_id"))
    return keyed.groupBy("row_id").agg(F.array_sort(F.collect_set("c")).alias("contig_ids")).filter("size(contig_ids) >= 2")


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contigs(spark, sf_dir).select((F.col("contig_id") % 4).alias("group_id"), "contig_id")


def sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(group_id, ord, contig_id): every group ordered by account balance."""
    s = table(spark, sf_dir, "supplier").join(contigs(spark, sf_dir), F.col("s_suppkey") == F.col("contig_id"))
    order = Window.partitionBy(F.col("contig_id") % 4).orderBy("s_acctbal", "s_suppkey")
    return s.select((F.col("contig_id") % 4).alias("group_id"), (F.row_number().over(order) - 1).alias("ord"), "contig_id")
