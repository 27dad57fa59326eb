"""The contact graph: counting, weighing and normalising links between contigs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactweave.functions.storage import stored
from contactweave.functions.watch import Watch


def link_counts(reads: DataFrame) -> DataFrame:
    """(lo, hi, pairs): read pairs for each two different contigs; counted on the map side first."""
    ends = reads.filter("ref_id <> next_ref_id").select(F.least("ref_id", "next_ref_id").alias("lo"), F.greatest("ref_id", "next_ref_id").alias("hi"))
    return ends.groupBy("lo", "hi").agg(F.count("*").alias("pairs"))


def add_counts(*parts: DataFrame) -> DataFrame:
    """Link counts of several inputs as those of all."""
    return reduce(DataFrame.unionByName, parts).groupBy("lo", "hi").agg(F.sum("pairs").alias("pairs"))


def both_ways(edges: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Each undirected row as two directed ones (start, end, ...), without a second scan."""
    rest = [c for c in edges.columns if c not in (lo, hi)]
    ways = F.array(F.struct(F.col(lo).alias("start"), F.col(hi).alias("end")), F.struct(F.col(hi).alias("start"), F.col(lo).alias("end")))
    return edges.select(F.explode(ways).alias("x"), *rest).select("x.start", "x.end", *rest)


def edge_weights(counts: DataFrame, contigs: DataFrame, min_links: int = 3, watch: Watch | None = None) -> DataFrame:
    """(lo, hi, pairs, weight) of the pairs with enough links: max_re^2 * pairs / re_lo / re_hi, cut to whole numbers; ``watch`` counts the pairs, and those with too few."""
    re = contigs.select("contig_id", F.col("re_count").cast("long").alias("re"))
    top = contigs.agg(F.max("re_count").cast("long")).scalar()
    rows = counts if watch is None else watch(counts, "links", too_few=F.col("pairs") < min_links)
    rows = rows.filter(F.col("pairs") >= min_links)
    rows = rows.join(re.select(F.col("contig_id").alias("lo"), F.col("re").alias("re_lo")), "lo").join(re.select(F.col("contig_id").alias("hi"), F.col("re").alias("re_hi")), "hi")
    rows = rows.withColumn("top", top)
    return rows.select("lo", "hi", "pairs", F.expr("(top * top * pairs) div (re_lo * re_hi)").cast("double").alias("weight"))


def node_factors(weighted: DataFrame, contigs: DataFrame) -> DataFrame:
    """(contig_id, degree, factor): weighted degree, and that over its mean; the mean counts every contig."""
    degree = both_ways(weighted.select("lo", "hi", "weight")).groupBy(F.col("start").alias("contig_id")).agg(F.sum("weight").alias("degree"))
    rows = contigs.select("contig_id", "re_count").join(degree, "contig_id", "left").withColumn("degree", F.coalesce("degree", F.lit(0.0)))
    mean = rows.agg(F.try_divide(F.sum("degree"), F.count("*").cast("double"))).scalar()
    return rows.withColumn("factor", F.try_divide(F.col("degree"), mean))


def invalid_nodes(factors: DataFrame, min_re: int = 10, max_density: float = 2.0, watch: Watch | None = None) -> DataFrame:
    """Contigs with too few sites or too many links; ``watch`` counts the contigs and both kinds."""
    few, dense = F.col("re_count") < min_re, F.coalesce(F.col("factor"), F.lit(0.0)) >= max_density
    rows = factors if watch is None else watch(factors, "contigs", few_sites=few, too_dense=~few & dense)
    return rows.filter(few | dense).select("contig_id")


def draft_edges(weighted: DataFrame, factors: DataFrame) -> DataFrame:
    """(start, end, pairs, weight), both directions: the weight over the factor of its start, rounded up."""
    factor = factors.select(F.col("contig_id").alias("start"), "factor")
    rows = both_ways(weighted).join(factor, "start")
    return rows.select("start", "end", "pairs", F.ceil(F.try_divide(F.col("weight"), F.col("factor"))).cast("double").alias("weight"))


def draft(reads: DataFrame, contigs: DataFrame, min_links: int = 3) -> DataFrame:
    """Read pairs to directed, normalised edges; the reads are counted once, and the weighted pairs stored."""
    weighted = stored(edge_weights(link_counts(reads), contigs, min_links), "weighted")
    return draft_edges(weighted, node_factors(weighted, contigs))
