"""The whole job on files, its resumption, BAM input, and the streaming extension."""

import gzip
import random
import struct
import zlib
from collections import Counter

import pytest

from contactweave.functions import storage
from contactweave.jobs.config import BuildConfig, DraftConfig, ExtractConfig, OrderingConfig, PartitionConfig
from contactweave.jobs.scaffold import Pipeline
from contactweave.operators.links import link_counts
from contactweave.sources import bam, bam_source, text_formats, writers
from contactweave.streaming.link_stream import count_stream, write_counts


def _blocks(raw, size):
    """The bytes in compressed blocks as the format describes them, and the empty one at the end."""
    for part in [raw[k : k + size] for k in range(0, len(raw), size)] + [b""]:
        deflate = zlib.compressobj(wbits=-15)
        data = deflate.compress(part) + deflate.flush()
        head = b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(data) + 25)
        yield head + data + struct.pack("<II", zlib.crc32(part), len(part))


def _write_bam(path, names, rows, size=60_000, rest=lambda k: b""):
    raw = b"BAM\1" + struct.pack("<i", 3) + b"@HD" + struct.pack("<i", len(names))
    for name, length in names:
        raw += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    parts = [raw]
    for k, (ref, pos, mapq, flag, n, next_ref, next_pos) in enumerate(rows):
        body = struct.pack("<iiBBHHHiiii", ref, pos, 2, mapq, 0, 0, flag, n, next_ref, next_pos, 0) + b"r\0" + b"\x11" * ((n + 1) // 2) + b"\x20" * n + rest(k)
        parts.append(struct.pack("<i", len(body)) + body)
    path.write_bytes(b"".join(_blocks(b"".join(parts), size)))


def _inputs(tmp_path):
    rng = random.Random(5)
    seqs = ["".join(rng.choice("ACGT") for _ in range(3000)) for _ in range(8)]
    (tmp_path / "c.fasta").write_text("".join(f">c{k} x\n{s[:1500]}\n{s[1500:]}\n" for k, s in enumerate(seqs)))
    pairs = []
    for _ in range(4000):
        a = rng.randrange(8)
        near = [b for b in range(8) if b != a and (b < 4) == (a < 4)]
        b = rng.choice(near) if rng.random() < 0.95 else rng.choice([b for b in range(8) if b != a])
        pairs.append((a, rng.randrange(3000), b, rng.randrange(3000)))
    (tmp_path / "r.pairs").write_text("#c\n" + "".join(f"r\tc{a}\t{p}\tc{b}\t{q}\t+\t-\tUU\n" for a, p, b, q in pairs[:2000]))
    names = [(f"c{k}", 3000) for k in (7, 6, 5, 4, 3, 2, 1, 0)] + [("zz", 5)]
    rows = [(7 - a, p, 60, 99, 150, 7 - b, q) for a, p, b, q in pairs[2000:]] + [(8, 0, 60, 99, 150, 0, 0), (-1, -1, 60, 4, 150, -1, -1)]
    _write_bam(tmp_path / "r.bam", names, rows)
    return seqs


def _decoded(spark, path):
    rows = bam.decoded(spark, str(path))
    return sorted(tuple(r)[1:] for r in bam.references(rows).collect()), sorted(tuple(r)[1:] for r in bam.alignments(rows).collect())


def test_bam(spark, tmp_path):
    rows = [(0, 5, 60, 99, 150, 1, 7), (-1, -1, 0, 4, 0, -1, -1)]
    _write_bam(tmp_path / "x.bam", [("a", 10), ("b", 20)], rows)
    assert _decoded(spark, tmp_path / "x.bam") == ([(0, "a", 10), (1, "b", 20)], sorted(rows))
    with gzip.open(tmp_path / "y.bam", "wb") as f:
        f.write(b"BAM\1")
    with pytest.raises(Exception, match="not a block"):
        _decoded(spark, tmp_path / "y.bam")
    _write_bam(tmp_path / "z.bam", [], [])
    assert _decoded(spark, tmp_path / "z.bam") == ([], [])


@pytest.mark.parametrize(("names", "count", "block", "most", "long"), [(3, 3000, 900, 1 << 13, 0), (4000, 500, 5000, 1 << 12, 0), (2, 40, 700, 1 << 11, 40000), (3, 3000, 60_000, 1 << 30, 0)])
def test_bam_splits(spark, tmp_path, names, count, block, most, long):
    """A file over many splits, with records and headers that span blocks and splits, equals what was written."""
    rng = random.Random(count)
    dictionary = [(f"contig{k}" + "x" * rng.randrange(30), rng.randrange(1, 1 << 30)) for k in range(names)]
    rows = [(rng.randrange(-1, names), rng.randrange(-1, 1 << 28), rng.randrange(256), rng.randrange(4096), rng.randrange(200), rng.randrange(-1, names), rng.randrange(-1, 1 << 28)) for _ in range(count)]
    noise = lambda k: rng.randbytes(rng.randrange(long) if long and k % 7 == 0 else rng.randrange(60))
    _write_bam(tmp_path / "x.bam", dictionary, rows, block, noise)
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in old:
            spark.conf.set(c, most)
        assert spark.read.text(str(tmp_path / "x.bam")).rdd.getNumPartitions() > (3 if most < 1 << 20 else 0)
        assert _decoded(spark, tmp_path / "x.bam") == (sorted((k, *d) for k, d in enumerate(dictionary)), sorted(rows))
        (tmp_path / "x.bam").write_bytes(b"".join(list(_blocks(b"BAM\1" + struct.pack("<ii", 0, 0) + struct.pack("<i", 90) + bytes(50), 40))))
        with pytest.raises(Exception, match="ends inside"):
            _decoded(spark, tmp_path / "x.bam")
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_written_alignments_read_back(spark, tmp_path):
    rng = random.Random(2)
    names = [(f"contig{k}", 1000 + k) for k in range(40)]
    rows = []
    for _ in range(3000):
        (a, m), (b, n) = rng.choice(names), rng.choice(names)
        rows.append((a, m, rng.randrange(1000), rng.randrange(256), rng.randrange(1 << 16), rng.randrange(300), b, n, rng.randrange(1000)))
    schema = "name string, length int, pos int, mapq short, flag int, l_seq int, next_name string, next_length int, next_pos int"
    bam.write_alignments(spark.createDataFrame(rows, schema).repartition(3), str(tmp_path / "bam"), most=700)
    found = bam.decoded(spark, str(tmp_path / "bam"))
    of = {(r.file, r.ref_no): (r.name, r.length) for r in bam.references(found).collect()}
    got = [(*of[r.file, r.ref_no], r.pos, r.mapq, r.flag, r.l_seq, *of[r.file, r.next_ref_no], r.next_pos) for r in bam.alignments(found).collect()]
    assert sorted(got) == sorted(rows) and len({f for f, _ in of}) == 3


@pytest.mark.parametrize(("names", "count", "block", "range_", "long"), [(3, 2000, 900, 1 << 13, 0), (900, 300, 5000, 1 << 12, 0), (2, 40, 700, 1 << 11, 9000), (3, 2000, 60_000, 1 << 30, 0), (2, 0, 100, 50, 0)])
def test_bam_as_a_data_source(spark, tmp_path, names, count, block, range_, long):
    """The format's rows are those written, whatever the ranges; a filter is pushed to the records' heads."""
    bam_source.register(spark)
    rng = random.Random(count)
    dictionary = [(f"contig{k}", rng.randrange(1, 1 << 30)) for k in range(names)]
    rows = [(rng.randrange(-1, names), rng.randrange(-1, 1 << 28), rng.randrange(256), rng.randrange(4096), rng.randrange(200), rng.randrange(-1, names), rng.randrange(-1, 1 << 28)) for _ in range(count)]
    _write_bam(tmp_path / "x.bam", dictionary, rows, block, lambda k: rng.randbytes(rng.randrange(long) if long and k % 7 == 0 else rng.randrange(60)))
    name = lambda k: None if k < 0 else dictionary[k][0]
    want = Counter((name(a), p, q, f, n, name(b), r) for a, p, q, f, n, b, r in rows)
    df = spark.read.format("bam").option("range", range_).load(str(tmp_path / "x.bam"))
    got = [tuple(r)[1:] for r in df.collect()]
    assert Counter(got) == want
    few = df.filter("mapq >= 40 AND flag < 1000 AND l_seq > 7")
    assert Counter(tuple(r)[1:] for r in few.collect()) == Counter({r: n for r, n in want.items() if r[2] >= 40 and r[3] < 1000 and r[4] > 7})
    plan = few._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("Filter") : plan.index("BatchScan")] if "Filter" in plan else ""
    assert "l_seq" in left and "mapq" not in left and "flag" not in left


def test_pipeline(spark, tmp_path):
    seqs = _inputs(tmp_path)
    job = Pipeline(spark, str(tmp_path / "out"), ExtractConfig(("GATC", "AT"), min_mapq=40), PartitionConfig(2), DraftConfig(min_re=1, max_density=9.0), OrderingConfig(ngen=30, max_gen=60, npop=20))
    got = job(str(tmp_path / "c.fasta"), [str(tmp_path / "r.pairs"), str(tmp_path / "r.bam")])
    groups = {}
    for r in got["groups"].collect():
        groups.setdefault(r.group_id, set()).add(r.contig_id)
    assert sorted(map(sorted, groups.values())) == [[0, 1, 2, 3], [4, 5, 6, 7]]
    assert sorted(r.n for r in got["scaffolds"].groupBy("object").agg({"seq": "count"}).toDF("object", "n").collect()) == [4, 4]
    text = "".join(r.seq for r in got["scaffolds"].collect())
    assert len(text) == 24000
    turned = str.maketrans("ACGT", "TGCA")
    assert all(s in text or s[::-1].translate(turned) in text for s in seqs)
    for key in ("Group_1", "Group_2"):
        parts = got["agp"].filter(f"object = '{key}'").orderBy("part_number").collect()
        assert [p.part_number for p in parts] == list(range(1, 8))
        assert all(a.object_end + 1 == b.object_beg for a, b in zip(parts, parts[1:], strict=False))
    job.write(got)
    assert spark.read.text(str(tmp_path / "out/scaffolds.agp")).count() == 14
    lines = [r.value for r in spark.read.text(str(tmp_path / "out/scaffolds.fasta")).collect()]
    assert sorted(x for x in lines if x[0] == ">") == [">Group_1", ">Group_2"] and sum(len(x) for x in lines if x[0] != ">") == 24000
    # A second run finds every stage complete and doesn't need its input.
    (tmp_path / "r.pairs").unlink()
    again = job(str(tmp_path / "c.fasta"), [str(tmp_path / "r.pairs"), str(tmp_path / "r.bam")])
    assert sorted(again["agp"].collect()) == sorted(got["agp"].collect())


def test_stages_alone(spark, tmp_path):
    """One stage makes what it needs and no more; a changed parameter makes only what depends on it anew."""
    _inputs(tmp_path)
    files = str(tmp_path / "c.fasta"), [str(tmp_path / "r.pairs")]
    made = lambda: {p.name.rsplit("-", 1)[0] for p in (tmp_path / "out").iterdir() if not p.name.endswith(".counts")}
    job = lambda **more: Pipeline(spark, str(tmp_path / "out"), ExtractConfig(("AT",)), PartitionConfig(2), **{"draft": DraftConfig(min_re=1, max_density=9.0), **more}).inputs(*files)
    assert set(job().stage("draft")) == {"counts_0", "links", "weighted", "factors", "edges", "invalid"}
    assert made() - {"input"} == {"sequences", "hits", "contigs", "windows", "reads", "counts", "links", "weighted", "factors", "edges", "invalid"}
    before = {p.name for p in (tmp_path / "out").iterdir()}
    job(draft=DraftConfig(min_re=1, max_density=0.5)).stage("draft")
    assert {p.name.rsplit("-", 1)[0] for p in (tmp_path / "out").iterdir() if p.name not in before and not p.name.endswith(".counts")} == {"invalid"}
    before = {p.name for p in (tmp_path / "out").iterdir()}
    # A file that is added is all that is decoded, and what depends on all of them made anew.
    added = job().inputs(files[0], [str(tmp_path / "r.bam"), *files[1]])
    added.table("edges")
    new = sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "out").iterdir() if p.name not in before and not p.name.endswith(".counts"))
    assert new == sorted(["input", "reads", "counts", "links", "weighted", "factors", "edges"])
    assert added.table("reads").count() > job().table("reads").count()
    # A file of the same name that has changed is another.
    old = job().table("contigs").count()
    (tmp_path / "c.fasta").write_text((tmp_path / "c.fasta").read_text() + ">new\nACGT\n")
    assert job().table("contigs").count() == old + 1
    job().dump("edges", str(tmp_path / "edges"))
    rows = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "edges"))
    assert rows.columns == ["start_name", "end_name", "pairs", "weight"] and rows.count() == job().table("edges").count() > 0


def test_fasta_gap(spark, tmp_path):
    _inputs(tmp_path)
    job = Pipeline(spark, str(tmp_path / "out"), ExtractConfig(("AT",), check_windows=False), PartitionConfig(2), DraftConfig(min_re=1, max_density=9.0), OrderingConfig(ngen=3, max_gen=5, npop=8), BuildConfig(fasta_gap=7))
    got = job(str(tmp_path / "c.fasta"), [str(tmp_path / "r.pairs")])["scaffolds"].collect()
    assert sorted(len(r.seq) for r in got) == [3000] * 2 + [3007] * 6


def test_storage(spark, tmp_path, monkeypatch):
    rows = storage.stored(spark.range(5), "five")
    assert storage.shared_dir(spark).endswith(spark.sparkContext.applicationId) and rows.count() == 5
    storage.cleanup(spark)
    assert not storage.exists(spark, storage.shared_dir(spark))

    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.master": "spark://host:7077", "spark.app.id": "a"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)
    Session.conf["spark.master"] = "local-cluster[3,2,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert storage.shared_dir(Session) == "hdfs://x/y/a"


DUMPED = {
    "nodes": ("contig_id int, name string, re_count int, length int", [(0, "A", 3, 100)], "0 A 3 100"),
    "edges": ("start int, end int, pairs long, weight double", [(0, 1, 5, 2.0)], "A B 5 2.0"),
    "reads": ("ref_id int, pos int, next_ref_id int, next_pos int", [(1, 7, 0, 9)], "B 7 A 9"),
    "group": ("group_id int, contig_id int", [(2, 1)], "2 1 B 50"),
    "chromosomes": ("group_id int, ord int, contig_id int, reversed boolean", [(2, 0, 1, True)], "2 0 B 50 -"),
    "alleles": ("row_id int, contig_ids array<int>", [(4, [1, 0])], None),
    "alignments": ("ref_id int, pos int, mapq int, flag int, l_seq int, next_ref_id int, next_pos int", [(0, 1, 60, 99, 150, 1, 8)], "A 1 60 99 150 B 8"),
}


@pytest.mark.parametrize("kind", writers.DUMPS)
def test_dumps_as_text(spark, tmp_path, kind):
    schema, data, want = DUMPED[kind]
    contigs = spark.createDataFrame([(0, "A", 3, 100), (1, "B", 4, 50)], "contig_id int, name string, re_count int, length int")
    rows = spark.createDataFrame(data, schema)
    dumped = writers.DUMPS[kind](rows) if kind == "nodes" else writers.DUMPS[kind](rows, contigs)
    writers.write_tsv(dumped, str(tmp_path / kind))
    back = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / kind))
    assert back.columns == dumped.columns
    if want:
        assert [" ".join(r) for r in back.collect()] == [want]
    else:
        assert [(r.row_id, r.names) for r in back.collect()] == [("4", "B\tA")]


def test_allele_job(spark, tmp_path):
    _inputs(tmp_path)
    (tmp_path / "alleles").write_text("Chr1\t1\tc0\tc4\t\nChr1\t2\tc1\tc5\t\nChr1\t3\tc1\n")
    job = Pipeline(spark, str(tmp_path / "out"), ExtractConfig(("AT",), check_windows=False), PartitionConfig(2), DraftConfig(min_re=1, max_density=9.0), OrderingConfig(ngen=5, max_gen=10, npop=10))
    got = job(str(tmp_path / "c.fasta"), [str(tmp_path / "r.pairs")], str(tmp_path / "alleles"))
    ids = {r.contig_id: r.group_id for r in got["groups"].collect()}
    assert ids.get(0) != ids.get(4) and ids.get(1) != ids.get(5)


def test_gzip_text(spark, tmp_path):
    with gzip.open(tmp_path / "p.pairs.gz", "wt") as f:
        f.write("r\tc1\t1\tc2\t2\t+\t-\tUU\n")
    assert text_formats.read_pairs(spark, str(tmp_path / "p.pairs.gz")).count() == 1


def test_stream(spark, tmp_path):
    schema = "ref_id int, pos int, next_ref_id int, next_pos int"
    a, b = [(0, 1, 1, 1), (1, 1, 0, 1), (2, 1, 2, 1)], [(0, 1, 1, 1), (2, 1, 1, 1)]
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for rows in (a, b):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        write_counts(count_stream(spark, source, 1), out, mark).awaitTermination()
    last = spark.read.parquet(out).groupBy("lo", "hi").agg({"pairs": "max"}).collect()
    assert sorted(map(tuple, last)) == sorted(map(tuple, link_counts(spark.createDataFrame(a + b, schema)).collect()))


def test_missing_files_are_named_at_once(spark, tmp_path):
    _inputs(tmp_path)
    job = Pipeline(spark, str(tmp_path / "out"), ExtractConfig(("AT",)), PartitionConfig(2)).inputs(str(tmp_path / "c.fasta"), [str(tmp_path / "no.bam"), str(tmp_path / "r.pairs")], str(tmp_path / "no.table"))
    assert job.missing("sequences") == [] and [x.rsplit("/", 1)[1] for x in job.missing("links")] == ["no.bam", "no.table"]
    with pytest.raises(FileNotFoundError, match="no.bam.*no.table"):
        job.table("edges")
    assert not (tmp_path / "out").exists() or not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("sequences")]


def test_counts_by_reason(spark, tmp_path):
    """What is counted while the reads are written adds up to what was read."""
    names = [("c0", 3000), ("c1", 3000), ("zz", 5)]
    rows = [(0, 5, 60, 99, 150, 1, 7), (0, 5, 60, 99, 150, 0, 7), (0, 5, 10, 99, 150, 1, 7), (0, 5, 60, 1024, 150, 1, 7), (2, 0, 60, 99, 150, 0, 0), (-1, -1, 0, 4, 0, -1, -1), (1, 900, 60, 99, 20, 0, 7)]
    _write_bam(tmp_path / "r.bam", names, rows)
    (tmp_path / "r.pairs").write_text("r\tc0\t1\tc1\t2\t+\t-\tUU\nr\tc0\t1\tc0\t2\t+\t-\tUU\n")
    (tmp_path / "c.fasta").write_text(">c0\nGATC" + "A" * 2000 + "\n>c1\nGATC" + "A" * 2000 + "\n")
    job = Pipeline(spark, str(tmp_path / "out"), ExtractConfig(("GATC",), window=100), PartitionConfig(2), DraftConfig(min_re=3)).inputs(str(tmp_path / "c.fasta"), [str(tmp_path / "r.bam"), str(tmp_path / "r.pairs")])
    job.stage("draft")
    got = {(r.label.rsplit("/", 1)[-1], r.what): r.n for r in job.counts().collect()}
    assert {k[1]: n for k, n in got.items() if k[0] == "r.bam"} == {"rows": 7, "unknown_contig": 2, "same_contig": 1, "mapping_quality": 1, "flags": 1}
    assert got["r.bam kept", "rows"] == 1 and got["r.pairs", "rows"] == 2 and got["r.pairs", "same_contig"] == 1 and got["r.pairs kept", "rows"] == 1
    assert (got["links", "rows"], got["links", "too_few"]) == (1, 1) and (got["contigs", "rows"], got["contigs", "few_sites"], got["contigs", "too_dense"]) == (2, 2, 0)
    # A run that finds its tables complete has the counts too.
    again = Pipeline(spark, str(tmp_path / "out"), ExtractConfig(("GATC",), window=100), PartitionConfig(2), DraftConfig(min_re=3)).inputs(str(tmp_path / "c.fasta"), [str(tmp_path / "r.bam"), str(tmp_path / "r.pairs")])
    assert sorted(again.counts().collect()) == sorted(job.counts().collect())
