"""Small cases worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from contactweave.functions.motifs import expand, motifs_of
from contactweave.functions.sequence import is_nucleotides, motif_count, record_name, reverse_complement, to_int
from contactweave.jobs.config import ExtractConfig, PartitionConfig
from contactweave.operators import allele, build, cluster, links, order, orient, reads, sites
from contactweave.sources import text_formats, writers


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_motifs():
    assert expand(["GANTC"]) == ["GAATC", "GACTC", "GAGTC", "GATTC"]
    assert expand(["RY"]) == ["AC", "AT", "GC", "GT"]
    assert expand(["N", "A"]) == ["A", "C", "G", "T"] and len(expand(["N", "A"], keep_duplicates=True)) == 5
    assert motifs_of("mboi") == ["GATC"] and motifs_of(["Arima", "HindIII"])[-1] == "AAGCTT"
    with pytest.raises(ValueError):
        expand(["GAXC"])


def test_sequence_functions(spark):
    r = spark.createDataFrame([("AACGTN",)], "s string").select(reverse_complement(F.col("s")), is_nucleotides(F.col("s")), motif_count(F.lit("AAAA"), ["AA"]), record_name(F.lit("c1 a>b")), to_int(F.lit("12x")), to_int(F.lit("x"))).first()
    assert tuple(r) == ("NACGTT", False, 2, "c1", 12, 0)


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">c1 a>b\nACGT\nGG\n>c2\nTTTT\n>c3\n>c4\nAC")
    assert rows(text_formats.read_fasta(spark, str(tmp_path / "a.fasta"))) == [(0, "c1", "ACGTGG"), (1, "c2", "TTTT"), (2, "c4", "AC")]


def test_pairs_and_alleles(spark):
    lines = spark.createDataFrame([("#h",), ("a\tb\t1\tc\t2\t+\t-",), ("r1\tc1\t10\tc2\t20\t+\t-\tUU",), ("",)], "value string")
    assert rows(text_formats.parse_pairs(lines)) == [("c1", 10, "c2", 20)]
    contigs = spark.createDataFrame([(0, "c1"), (1, "c2")], "contig_id int, name string")
    table = spark.createDataFrame([(0, "Chr1\t1\tc1\tc2\tzz\t\n"), (1, "Chr1\t2\tc1"), (2, "Chr2\t3\tc2\tc1\tc1\n")], "row_id int, value string")
    assert rows(text_formats.parse_allele_rows(table, contigs)) == [(0, [0, 1]), (2, [0, 1])]
    named = reads.bind_names(spark.createDataFrame([("c1", 1, "c2", 2), ("c1", 1, "zz", 2)], "name string, pos int, next_name string, next_pos int"), contigs)
    assert rows(named) == [(0, 1, 1, 2)]


def test_sites(spark):
    seq = spark.createDataFrame([(0, "AAGATCGATCTT"), (1, "AAAA"), (2, "gatc"), (3, "")], "contig_id int, seq string")
    assert rows(sites.site_positions(seq, ["GATC"])) == [(0, "GATC", 2, 12), (0, "GATC", 6, 12), (2, "GATC", 0, 4)]
    assert rows(sites.site_positions(seq, ["GATC"], case_compat=True)) == [(0, "GATC", 2, 12), (0, "GATC", 6, 12)]
    assert rows(sites.site_counts(seq, ["GATC"], None, True))[2] == (2, 4, 1)
    assert rows(sites.site_counts(seq, ["GATC"])) == [(0, 12, 3), (1, 4, 1), (2, 4, 2), (3, 0, 1)]
    assert rows(sites.site_positions(seq, ["AA"]))[-2:] == [(1, "AA", 0, 4), (1, "AA", 2, 4)]
    hits = spark.createDataFrame([(0, p, 5000) for p in (100, 900, 3000, 4800)], "contig_id int, pos int, length int")
    windows = sites.site_windows(hits, 500)
    assert rows(windows) == [(0, 0, 1400), (0, 2500, 3500), (0, 4300, 5000)]
    found = spark.createDataFrame([(0, p, 1, 0) for p in (1400, 1401, 2349, 2350)], "ref_id int, pos int, next_ref_id int, next_pos int")
    assert [r.pos for r in reads.filter_pairs(found, windows, 150).orderBy("pos").collect()] == [1400, 2350]


def test_windows_meet_reads_of_any_length(spark, monkeypatch):
    monkeypatch.setattr(reads, "BINS", (64, 1024, 1 << 31))
    rng = random.Random(2)
    windows = [(rng.randrange(3), a, a + rng.randrange(1, 300)) for a in rng.sample(range(20000), 25)]
    found = [(rng.randrange(4), rng.randrange(-1, 20000), k, rng.choice([0, 1, 63, 64, 150, 1023, 1024, 5000])) for k in range(600)]
    df = spark.createDataFrame(found, "ref_id int, pos int, k int, n int")
    got = reads.in_windows(df, spark.createDataFrame(windows, "contig_id int, start int, end int"), F.col("n"))
    assert got.columns == df.columns
    assert sorted(r.k for r in got.collect()) == sorted(k for c, p, k, n in found if any(c == w and p + n >= a and p <= b for w, a, b in windows))


def test_alignment_filter(spark):
    cases = [(40, 99), (39, 99), (0, 99), (255, 99), (60, 1024), (60, 256), (60, 4)]
    df = spark.createDataFrame([(0, k, 1, 0, q, f, 150) for k, (q, f) in enumerate(cases)] + [(None, 90, 1, 0, 60, 0, 150), (1, 91, 1, 0, 60, 0, 150)], "ref_id int, pos int, next_ref_id int, next_pos int, mapq int, flag int, l_seq int")
    assert [r.pos for r in reads.filter_alignments(df).orderBy("pos").collect()] == [0]
    assert [r.pos for r in reads.filter_alignments(df, check_flags=False).orderBy("pos").collect()] == [0, 4, 5, 6]


def _draft(spark):
    contigs = spark.createDataFrame([(0, "a", 1, 10), (1, "b", 1, 20), (2, "c", 1, 40)], "contig_id int, name string, length int, re_count int")
    ends = [(0, 1)] * 3 + [(1, 0)] * 2 + [(0, 2)] * 3 + [(1, 2)] * 2 + [(1, 1)]
    return contigs, spark.createDataFrame([(a, 0, b, 0) for a, b in ends], "ref_id int, pos int, next_ref_id int, next_pos int")


def test_draft(spark):
    contigs, pairs = _draft(spark)
    counts = links.link_counts(pairs)
    assert rows(counts) == [(0, 1, 5), (0, 2, 3), (1, 2, 2)]
    weighted = links.edge_weights(counts, contigs, 3)
    assert rows(weighted) == [(0, 1, 5, 40.0), (0, 2, 3, 12.0)]
    factors = links.node_factors(weighted, contigs)
    assert [(r.contig_id, round(r.factor, 6)) for r in factors.orderBy("contig_id").collect()] == [(0, 1.5), (1, 1.153846), (2, 0.346154)]
    assert rows(links.draft_edges(weighted, factors)) == [(0, 1, 5, 27.0), (0, 2, 3, 8.0), (1, 0, 5, 35.0), (2, 0, 3, 35.0)]
    assert rows(links.invalid_nodes(factors, 15, 1.5)) == [(0,)]
    one = spark.createDataFrame([(0, "a", 1, 4), (1, "b", 1, 5), (2, "c", 1, 7)], "contig_id int, name string, length int, re_count int")
    assert rows(links.edge_weights(spark.createDataFrame([(0, 1, 3)], "lo int, hi int, pairs long"), one)) == [(0, 1, 3, 7.0)]


def test_draft_without_edges(spark):
    contigs, pairs = _draft(spark)
    assert links.draft(pairs.limit(0), contigs).count() == 0


def test_alleles(spark):
    counts = spark.createDataFrame([(0, 1, 9), (0, 2, 9), (0, 3, 7), (1, 2, 6), (1, 3, 1)], "lo int, hi int, pairs long")
    table = spark.createDataFrame([(0, [0, 1]), (1, [2, 3])], "row_id int, contig_ids array<int>")
    assert rows(allele.prune_within_rows(counts, table), "lo", "hi") == [(0, 2), (0, 3), (1, 2), (1, 3)]
    assert rows(allele.match_rows(counts, table), "lo", "hi") == [(0, 2), (1, 3)]
    assert rows(allele.conflicts(table)) == [(0, [1]), (1, [0]), (2, [3]), (3, [2])]
    empty = spark.createDataFrame([], "row_id int, contig_ids array<int>")
    assert allele.match_rows(counts, empty).count() == 5


def _square(spark):
    pairs = [(0, 1, 10.0), (2, 3, 8.0), (1, 2, 2.0)]
    edges = spark.createDataFrame([(a, b, 5, w) for x, y, w in pairs for a, b in ((x, y), (y, x))], "start int, end int, pairs long, weight double")
    contigs = spark.createDataFrame([(k, f"c{k}", 100, 10) for k in range(4)], "contig_id int, name string, length int, re_count int")
    return edges, contigs, spark.createDataFrame([], "contig_id int")


def test_partition(spark):
    edges, contigs, none = _square(spark)
    assert rows(cluster.partition(edges, none, contigs, 2)) == [(1, 0), (1, 1), (2, 2), (2, 3)]
    veto = spark.createDataFrame([(7, [2, 3])], "row_id int, contig_ids array<int>")
    found = cluster.partition(edges, none, contigs, 2, veto)
    assert rows(found) == [(1, 0), (1, 1), (1, 2)]
    skipped = spark.createDataFrame([(3,)], "contig_id int")
    assert cluster.recover(edges, found, skipped, 3.0).count() == 0
    assert rows(cluster.recover(edges, found, skipped, 2.5), "contig_id", "group_id") == [(3, 1)]
    assert rows(cluster.group_stats(found, contigs)) == [(1, 3, 30, 300, 10)]


@pytest.mark.parametrize(("linkage", "kept"), [([9.0, 3.0], True), ([9.0, 4.0], False), ([2.9], False), ([9.0], True)])
def test_recover_rule(spark, linkage, kept):
    edges = spark.createDataFrame([(9, k, 1, w) for k, w in enumerate(linkage)], "start int, end int, pairs long, weight double")
    members = spark.createDataFrame([(k + 1, k) for k in range(len(linkage))], "group_id int, contig_id int")
    got = rows(cluster.recover(edges, members, spark.createDataFrame([(9,)], "contig_id int"), 3.0), "contig_id", "group_id")
    assert got == ([(9, 1)] if kept else [])


def test_order_and_orientation(spark):
    contigs = spark.createDataFrame([(0, "A", 100, 1), (1, "B", 50, 1), (2, "C", 200, 1)], "contig_id int, name string, length int, re_count int")
    sequence = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 2)], "group_id int, ord int, contig_id int")
    mids = order.midpoints(sequence, contigs)
    assert [r.mid for r in mids.orderBy("ord").collect()] == [50, 125, 250]
    inside = spark.createDataFrame([(1, 0, 1, 5), (1, 0, 2, 3)], "group_id int, lo int, hi int, pairs long")
    assert round(order.order_scores(inside, mids).first().score, 7) == -0.0816667
    pairs = spark.createDataFrame([(0, 10, 1, 40)], "ref_id int, pos int, next_ref_id int, next_pos int")
    costs = orient.orientation_costs(pairs, sequence.filter("contig_id < 2"), contigs)
    assert rows(costs, "contig_id", "cost_forward", "cost_reversed") == [(0, 90.0, 10.0), (1, 40.0, 10.0)]
    assert rows(orient.orient(costs), "contig_id", "reversed") == [(0, True), (1, True)]


def test_build(spark):
    contigs = spark.createDataFrame([(0, "A", 100), (1, "B", 50)], "contig_id int, name string, length int")
    chromosomes = spark.createDataFrame([(1, 0, 0, False), (1, 1, 1, True)], "group_id int, ord int, contig_id int, reversed boolean")
    got = build.agp(chromosomes, contigs).orderBy("part_number").collect()
    assert [" ".join(str(r[c]) for c in writers.AGP_COLUMNS[1:]) for r in got] == ["1 100 1 W A 1 100 +", "101 200 2 U 100 contig yes map", "201 250 3 W B 1 50 -"]
    seqs = spark.createDataFrame([(0, "AAC"), (1, "GT")], "contig_id int, seq string")
    assert rows(build.scaffold_sequences(chromosomes, seqs)) == [("Group_1", "AACAC")]
    assert rows(build.scaffold_sequences(chromosomes, seqs, gap=2)) == [("Group_1", "AACNNAC")]
    assert rows(build.scaffold_pieces(chromosomes, seqs)) == [("Group_1", 0, 0, "AAC"), ("Group_1", 1, 0, "AC")]
    assert rows(build.scaffold_pieces(chromosomes, seqs, gap=2)) == [("Group_1", 0, 0, "AAC"), ("Group_1", 1, 0, "NNAC")]


def test_config():
    with pytest.raises(ValueError):
        ExtractConfig(())
    with pytest.raises(ValueError):
        PartitionConfig(0)
