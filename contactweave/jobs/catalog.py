"""The registered queries: each operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.functions.motifs import expand
from contactweave.functions.sequence import is_nucleotides, reverse_complement
from contactweave.functions.storage import shared_dir, stored
from contactweave.functions.watch import Watch
from contactweave.operators import allele, build, cluster, links, order, orient, reads, sites
from contactweave.sources import bindings as b
from contactweave.sources import bam, text_formats, writers

MOTIFS = expand(["GAT", "CAT", "TAG", "GATC"])
HALF = 50
#: Stricter than the defaults so that these tables have invalid contigs.
MIN_RE, MAX_DENSITY, MIN_LINKS = 500, 1.03, 3
GROUPS, RATIO = 4, 1.05
#: Items at most, on average, whose alignments go to one file.
FILE_ITEMS = 2_000_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


class Graph(NamedTuple):
    contigs: DataFrame
    weighted: DataFrame
    factors: DataFrame

    @property
    def edges(self) -> DataFrame:
        return links.draft_edges(self.weighted, self.factors)

    @property
    def invalid(self) -> DataFrame:
        return links.invalid_nodes(self.factors, MIN_RE, MAX_DENSITY)


def _graph(s: SparkSession, d: str) -> Graph:
    """The reads are counted once: what follows reads the far smaller weighted pairs."""
    contigs = stored(b.contigs(s, d), "contigs")
    weighted = stored(links.edge_weights(links.link_counts(b.reads(s, d)), contigs, MIN_LINKS), "weighted")
    return Graph(contigs, weighted, links.node_factors(weighted, contigs))


def _chromosomes(s: SparkSession, d: str) -> DataFrame:
    return orient.orient(orient.orientation_costs(b.reads(s, d), b.sequence(s, d), b.contigs(s, d)))


def _site_windows(s: SparkSession, d: str) -> DataFrame:
    """Windows on supplier contigs, around sites derived from their line items."""
    items = b.table(s, d, "lineitem").select(F.col("l_suppkey").cast("int").alias("contig_id"), F.expr("l_partkey * 7919L + l_linenumber * 104729L").alias("x"))
    sites_ = items.join(b.contigs(s, d).select("contig_id", "length"), "contig_id").select("contig_id", F.expr("CAST(x % length AS INT)").alias("pos"), "length")
    return sites.site_windows(sites_, 300)


@query
def contig_table(s, d):
    return writers.dump_nodes(b.contigs(s, d))


@query
def link_counts(s, d):
    return links.link_counts(b.reads(s, d))


@query
def link_counts_symmetric(s, d):
    return links.both_ways(links.link_counts(b.reads(s, d)))


@query
def edge_weights(s, d):
    contigs = b.contigs(s, d)
    return links.edge_weights(links.link_counts(b.reads(s, d)), contigs, MIN_LINKS)


@query
def node_factors(s, d):
    return _graph(s, d).factors.select("contig_id", "degree", F.round("factor", 9).alias("factor"))


@query
def invalid_nodes(s, d):
    return _graph(s, d).invalid


@query
def invalid_summary(s, d):
    g = _graph(s, d)
    bad = g.invalid.withColumn("bad", F.lit(True))
    return g.contigs.join(bad, "contig_id", "left").agg(F.count("*").alias("contigs"), F.count_if(F.col("bad")).alias("invalid"), F.sum(F.col("length").cast("long")).alias("total_bp"))


@query
def draft_edges(s, d):
    return _graph(s, d).edges


@query
def motif_counts(s, d):
    return sites.site_counts(b.sequences(s, d), MOTIFS).withColumn("length", F.col("length").cast("int"))


@query
def motif_weight_counts(s, d):
    return sites.site_counts(b.sequences(s, d), MOTIFS, expand(["GANT"])).withColumn("length", F.col("length").cast("int"))


@query
def motif_positions(s, d):
    return sites.motif_hits(b.sequences(s, d), MOTIFS).withColumn("pos", F.col("pos").cast("int"))


@query
def site_ranges(s, d):
    found = sites.site_windows(sites.site_positions(b.sequences(s, d), MOTIFS), HALF)
    return found.select("contig_id", *[F.col(c).cast("int").alias(c) for c in ("start", "end")])


@query
def nucleotide_check(s, d):
    docs = b.table(s, d, "documents")
    return docs.select("doc_id", is_nucleotides(F.upper("text")).alias("text_ok"), is_nucleotides(F.upper(F.regexp_replace("text", "[^ACGTacgt]", ""))).alias("seq_ok"))


@query
def bam_filter(s, d):
    return reads.filter_alignments(b.alignments(s, d), _site_windows(s, d))


@query
def filter_counts(s, d):
    """Alignments read, dropped by reason and kept, counted while the filtered reads are written: no scan of its own."""
    watch = Watch()
    stored(reads.filter_alignments(b.alignments(s, d), _site_windows(s, d), watch=watch), "filtered")
    return s.createDataFrame(watch.take(), "label string, what string, n long")  # a row a reason


@query
def bam_filter_no_flags(s, d):
    return reads.filter_alignments(b.alignments(s, d), None, 40, check_flags=False)


@query
def bam_alignments(s, d):
    """Alignments by contig, written as files of BAM blocks, each with a dictionary of its own, and read back."""
    contigs = stored(b.contigs(s, d).select("contig_id", "name", "length"), "contigs")
    rows, path = b.alignments(s, d), f"{shared_dir(s)}/bam-{uuid.uuid4().hex}"
    for key, name, length in (("ref_id", "name", "length"), ("next_ref_id", "next_name", "next_length")):
        rows = rows.join(contigs.select(F.col("contig_id").alias(key), F.col("name").alias(name), F.col("length").alias(length)), key)
    # A file names its contigs, so the names grow with files times contigs: a file is of many tasks' rows.
    cores = s.sparkContext.defaultParallelism
    waves = b.table(s, d, "lineitem").count() // (FILE_ITEMS * cores) + 1
    bam.write_alignments(rows.coalesce(waves * cores), path)
    found = bam.decoded(s, path)
    bound = reads.bind_references(bam.alignments(found), stored(bam.references(found), "references"), contigs)
    return bound.select("ref_id", "pos", "mapq", "flag", "l_seq", "next_ref_id", "next_pos")


@query
def pairs_filter(s, d):
    return reads.filter_pairs(b.reads(s, d), _site_windows(s, d), 150)


@query
def range_semi_join(s, d):
    return reads.in_windows(b.reads(s, d), _site_windows(s, d), F.lit(0))


@query
def pairs_parse(s, d):
    rows = b.reads(s, d)
    names = b.contigs(s, d).select("contig_id", "name")
    rows = rows.join(names.select(F.col("contig_id").alias("ref_id"), F.col("name").alias("n1")), "ref_id").join(names.select(F.col("contig_id").alias("next_ref_id"), F.col("name").alias("n2")), "next_ref_id")
    tail = F.when(F.col("pos") % 5 == 0, F.lit("")).otherwise(F.lit("\tUU"))
    head = F.when(F.col("pos") % 7 == 0, F.lit("#r")).otherwise(F.lit("r"))
    lines = rows.select(F.concat(F.concat_ws("\t", head, "n1", F.col("pos").cast("string"), "n2", F.when(F.col("next_pos") % 11 == 0, F.lit("x")).otherwise(F.col("next_pos").cast("string")), F.lit("+"), F.lit("-")), tail).alias("value"))
    return reads.bind_names(text_formats.parse_pairs(lines), b.contigs(s, d))


@query
def fasta_records(s, d):
    docs = b.table(s, d, "documents").select(F.col("doc_id").alias("place"), F.concat(F.lit(">doc"), "doc_id", F.lit(" "), "lang", F.lit("\n"), F.regexp_replace(F.regexp_replace("text", "[^ACGTacgt\n]", ""), "^\n+", "")).alias("value"))
    return text_formats.fasta_records(docs)


@query
def allele_text_rows(s, d):
    names = b.contigs(s, d).select("contig_id", "name")
    each = b.allele_rows(s, d).select("row_id", F.explode("contig_ids").alias("contig_id")).join(names, "contig_id")
    lines = each.groupBy("row_id").agg(F.sort_array(F.collect_list("name")).alias("names")).select("row_id", F.concat(F.lit("Chr\t"), F.col("row_id"), F.lit("\tunknown\t"), F.array_join("names", "\t"), F.lit("\t\n")).alias("value"))
    return text_formats.parse_allele_rows(lines, b.contigs(s, d)).select("row_id", F.array_join(F.transform("contig_ids", lambda x: x.cast("string")), ",").alias("contig_ids"))


@query
def allele_conflicts(s, d):
    return allele.conflict_texts(b.allele_rows(s, d))


@query
def allele_intra_row_prune(s, d):
    return allele.prune_within_rows(links.link_counts(b.reads(s, d)), b.allele_rows(s, d))


@query
def allele_row_candidates(s, d):
    return allele.row_candidates(allele.prune_within_rows(links.link_counts(b.reads(s, d)), b.allele_rows(s, d)), b.allele_rows(s, d))


@query
def allele_greedy_match(s, d):
    return allele.match_rows(links.link_counts(b.reads(s, d)), b.allele_rows(s, d))


@query
def merge_ops(s, d):
    g = _graph(s, d)
    return cluster.merge_ops(g.edges, g.invalid)


@query
def cluster_linkage(s, d):
    found = cluster.cluster_linkage(_graph(s, d).edges, b.groups(s, d))
    return found.select("from_group", "to_group", "total", F.round("linkage", 9).alias("linkage"))


@query
def cluster_conflicts(s, d):
    return cluster.cluster_conflicts(b.allele_rows(s, d), b.groups(s, d))


@query
def partition_groups(s, d):
    g = _graph(s, d)
    return cluster.partition(stored(g.edges, "edges"), stored(g.invalid, "invalid"), g.contigs, GROUPS, b.allele_rows(s, d))


@query
def recover_contigs(s, d):
    g = _graph(s, d)
    bad = stored(g.invalid, "invalid")
    members = b.groups(s, d).join(bad, "contig_id", "left_anti")
    found = cluster.recover(g.edges, members, bad, RATIO)
    return found.select("contig_id", "group_id", F.round("best", 6).alias("best"), F.round("second", 6).alias("second"))


@query
def group_stats(s, d):
    return cluster.group_stats(b.groups(s, d), b.contigs(s, d))


@query
def group_edges(s, d):
    return order.group_edges(_graph(s, d).edges, b.groups(s, d))


@query
def order_midpoints(s, d):
    return order.midpoints(b.sequence(s, d), b.contigs(s, d))


@query
def order_score(s, d):
    g = _graph(s, d)
    mids = order.midpoints(b.sequence(s, d), g.contigs)
    return order.order_scores(order.group_edges(g.edges, b.groups(s, d)), mids).select("group_id", F.round("score", 6).alias("score"))


@query
def ordering(s, d):
    g = _graph(s, d)
    inside = stored(order.group_edges(g.edges, b.groups(s, d)), "inside")
    return order.order_groups(inside, b.groups(s, d), g.contigs)


@query
def orientation_costs(s, d):
    return orient.orientation_costs(b.reads(s, d), b.sequence(s, d), b.contigs(s, d))


@query
def orientation(s, d):
    return _chromosomes(s, d)


@query
def reverse_complements(s, d):
    return b.sequences(s, d).select("contig_id", reverse_complement(F.col("seq")).alias("seq"))


@query
def agp(s, d):
    return build.agp(_chromosomes(s, d), b.contigs(s, d))


@query
def scaffold_fasta(s, d):
    seq = b.sequences(s, d)
    chromosomes = seq.select((F.col("contig_id") % 16).alias("group_id"), F.floor(F.col("contig_id") / 16).cast("int").alias("ord"), "contig_id", (F.col("contig_id") % 3 == 0).alias("reversed"))
    return build.scaffold_sequences(chromosomes, seq)


@query
def dump_edges(s, d):
    g = _graph(s, d)
    return writers.dump_edges(g.edges, g.contigs)


@query
def dump_reads(s, d):
    return writers.dump_reads(b.reads(s, d), b.contigs(s, d))


@query
def dump_alignments(s, d):
    return writers.dump_alignments(b.alignments(s, d), b.contigs(s, d))


@query
def dump_group(s, d):
    return writers.dump_group(b.groups(s, d), b.contigs(s, d))


@query
def dump_chromosomes(s, d):
    return writers.dump_chromosomes(_chromosomes(s, d), b.contigs(s, d))


@query
def dump_alleles(s, d):
    return writers.dump_alleles(b.allele_rows(s, d), b.contigs(s, d))


@query
def event_adjacency(s, d):
    """Another contact graph: users of events that follow each other."""
    at = b.table(s, d, "events").select("user_id", "ts", "event_id", F.date_trunc("hour", "ts").alias("hour"))
    order_ = Window.partitionBy("hour").orderBy("ts", "event_id")
    rows = at.select(F.col("user_id").alias("ref_id"), F.lead("user_id").over(order_).alias("next_ref_id")).filter("next_ref_id IS NOT NULL")
    return links.link_counts(rows)
