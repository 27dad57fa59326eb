"""Contigs as chunks: reading, searching, merging windows and writing them, whatever the size of a chunk."""

import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from contactweave.functions.sequence import reverse_complement
from contactweave.operators import build, sites
from contactweave.sources import chunks, text_formats, writers

MOTIFS = ["GATC", "AA", "ATA", "CGGCG", "ACACA", "GGG", "T"]


def whole(rows):
    """{contig_id: sequence} of chunks."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.contig_id, r.start)):
        assert r.start == len(out.get(r.contig_id, "")) and (r.own > 0 or r.start == 0)
        out[r.contig_id] = out.get(r.contig_id, "") + r.seq[: r.own]
    return out


def naive_hits(seqs, motifs):
    return sorted((c, m, x.start()) for c, s in seqs.items() for m in motifs for x in re.finditer(m, s.upper()))


def naive_windows(hits, sizes, half):
    out = []
    for c in sizes:
        for p in sorted({p for k, _, p in hits if k == c}):
            a, z = max(0, p - half), sizes[c] if p > sizes[c] - half else p + half
            if out and out[-1][0] == c and a < out[-1][2]:
                out[-1][2] = max(out[-1][2], z)
            else:
                out.append([c, a, z])
    return sorted(map(tuple, out))


@pytest.fixture(scope="module")
def seqs():
    rng = random.Random(6)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    return {0: text(900, "ACGT"), 1: "A" * 333, 2: "ATA" * 77 + "TA" * 50, 3: text(500, "AC") + text(300, "ACg"), 4: "", 5: "GATC", 6: "cggcgGCGGCG" * 30, 7: "T" * 64, 8: text(2000, "acgtACGTN")}


@pytest.mark.parametrize(("chunk", "segment"), [(3, 50), (64, 333), (1 << 20, 1 << 20)])
def test_hits_and_windows_for_any_chunk(spark, seqs, chunk, segment):
    df = spark.createDataFrame(list(seqs.items()), "contig_id int, seq string")
    cut = chunks.chunked(df, chunk)
    assert whole(cut.collect()) == seqs
    hits, sizes = sites.search(cut, MOTIFS)
    want = naive_hits(seqs, MOTIFS)
    assert sorted(map(tuple, hits.collect())) == want
    assert {r.contig_id: r.length for r in sizes.collect()} == {c: len(s) for c, s in seqs.items()}
    for motifs, counted in ((MOTIFS, MOTIFS), (["GATC"], ["AA", "AA", "T"])):
        found = {r.contig_id: r.re_count for r in sites.site_counts(cut, motifs, counted if counted != motifs else None).collect()}
        assert found == {c: 1 + sum(counted.count(m) for k, m, _ in want if k == c) for c in seqs}
    few = [h for h in want if h[1] in ("GATC", "ACACA")]
    at = spark.createDataFrame([(c, p, len(seqs[c])) for c, _, p in few], "contig_id int, pos long, length long")
    for half in (0, 3, 40, 5000):
        assert sorted(map(tuple, sites.site_windows(at, half, segment).collect())) == naive_windows(few, {c: len(s) for c, s in seqs.items()}, half)


def test_lower_case_as_written(spark, seqs):
    df = spark.createDataFrame(list(seqs.items()), "contig_id int, seq string")
    got = sorted(map(tuple, sites.motif_hits(chunks.chunked(df, 9), ["GATC", "CGGCG"], case_compat=True).collect()))
    assert got == sorted((c, m, x.start()) for c, s in seqs.items() for m in ("GATC", "CGGCG") for x in re.finditer(m, s))
    odd = spark.createDataFrame([(0, "ßgatcŉgatc")], "contig_id int, seq string")
    assert sorted(r.pos for r in sites.motif_hits(odd, ["GATC"]).collect()) == [1, 6]


@pytest.mark.parametrize(("chunk", "split"), [(7, 1500), (100, 4000), (1 << 20, 1 << 20)])
def test_fasta_as_chunks_equals_whole_strings(spark, seqs, tmp_path, chunk, split):
    """Wrapped and unwrapped lines, blank lines, records without a sequence, names with blanks, line ends of two characters, splits inside records."""
    rng = random.Random(chunk)
    text = "first line without its mark\n"
    for c, s in seqs.items():
        width = rng.choice([1, 13, 60, 5000])
        end = rng.choice(["\n", "\r\n"])
        text += f">c{c} about > {c}{end}" + "".join(s[k : k + width] + end + rng.choice(["", "", "\n", " \n"]) for k in range(0, len(s), width))
    path = tmp_path / "a.fasta"
    path.write_text(text + ">last\nAC\nGT")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = chunks.read_fasta_chunks(spark, str(path), chunk, 5)
        want = text_formats.read_fasta(spark, str(path)).collect()
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert whole(rows) == {r.contig_id: r.seq for r in want}
    assert {(r.contig_id, r.name) for r in rows} == {(r.contig_id, r.name) for r in want}
    for r in rows:
        assert r.seq == whole(rows)[r.contig_id][r.start : r.start + chunk + 5] and r.own == min(chunk, len(whole(rows)[r.contig_id]) - r.start)


def test_empty_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_text("")
    assert chunks.read_fasta_chunks(spark, str(tmp_path / "a.fasta")).count() == 0


@pytest.mark.parametrize("gap", [0, 3])
def test_two_scaffolds_by_eight_tasks(spark, seqs, tmp_path, gap):
    df = spark.createDataFrame([(c, s) for c, s in seqs.items() if s], "contig_id int, seq string")
    placed = [(1, 0, 0, False), (1, 1, 1, True), (1, 2, 2, False), (2, 0, 3, True), (2, 1, 5, False), (2, 2, 6, True), (2, 3, 8, False)]
    chromosomes = spark.createDataFrame(placed, "group_id int, ord int, contig_id int, reversed boolean")
    turned = {r.contig_id: r.t for r in df.select("contig_id", reverse_complement(F.col("seq")).alias("t")).collect()}
    want = {g: ("N" * gap).join(turned[c] if back else seqs[c] for k, _, c, back in placed if k == g) for g in (1, 2)}
    pieces = build.scaffold_pieces(chromosomes, chunks.chunked(df, 50), gap)
    assert {r.object: r.seq for r in build.scaffold_sequences(chromosomes, df, gap).collect()} == {f"Group_{g}": s for g, s in want.items()}
    path = str(tmp_path / "out.fasta")
    writers.write_fasta(pieces, path, tasks=8)
    files = sorted(glob.glob(f"{path}/part-*"))
    parts = [open(f).read() for f in files]
    assert len(files) == 8 and all(parts)
    text = "".join(parts)
    records = {r.split("\n", 1)[0]: r for r in text.split(">")[1:]}
    assert {n: r.split("\n", 1)[1].replace("\n", "") for n, r in records.items()} == {f"Group_{g}": s for g, s in want.items()}
    listed = [r for f in glob.glob(f"{path}.files/part-*") for r in (line.split("\t") for line in open(f).read().splitlines())]
    assert sorted((f, int(a), int(n)) for f, a, n in listed) == [(f.rsplit("/", 1)[1], sum(map(len, parts[:k])), len(parts[k])) for k, f in enumerate(files)]
    objects = [line.split("\t") for f in glob.glob(f"{path}.objects/part-*") for line in open(f).read().splitlines()]
    assert {n: text[int(a) : int(a) + int(size)] for n, a, size in objects} == {n: ">" + r for n, r in records.items()}
