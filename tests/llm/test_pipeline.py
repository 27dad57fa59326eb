"""The corpus pipeline, stage by stage, against brute force on each stage's own input."""

import itertools
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_pairs import alike, naive_removal, naive_set, roots
from test_text_models import check_packing

from contactweave.functions.storage import stored
from contactweave.llm import mixing, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def one_each(docs):
    """The smallest ids of the groups that pairs of texts with a similarity of 0.8 or more connect, by brute force."""
    sets = {r.doc_id: naive_set(r.text) for r in docs.collect()}
    return sorted(set(roots(sets, [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if alike(sets[a], sets[b])]).values()))


def stages(spark, docs, sf):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf), name))
    return out


def test_stages(spark, sf):
    raw, good, single, cut, mixed, packed = stages(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert all(d.columns == COLUMNS for d in (good, single, cut, mixed))
    kept = {r.doc_id for r in quality.ledger(raw).collect() if r.fail_bits & quality.mask("prose-1") == 0}
    assert {r.doc_id for r in good.collect()} == kept and 0 < len(kept) < raw.count()
    assert sorted(r.doc_id for r in single.collect()) == one_each(good) and single.count() < good.count()
    want = {d: n - gone for d, n, gone, _, _ in naive_removal([(r.doc_id, r.text) for r in single.collect()])}
    for r in cut.collect():
        assert want[r.doc_id] - 200 * 3 < len(r.text.encode()) <= want[r.doc_id] and r.n_chars == len(r.text)
    copies = {r.doc_id: r.copies for r in mixing.mix(cut).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in copies.items() if n})
    check_packing(packed.collect(), [(r.doc_id, r.text) for r in mixed.collect()])


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_odd_input(spark, sf):
    long = " ".join(f"w{k}" for k in range(20000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, long, "en", "a"), (3, long, "en", "a"), (None, " ".join(f"v{k}" for k in range(50)), None, None), (5, "# $ % & " * 9, "de", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = {c: F.lit("own") for c in ("size", "target", "copies", "fingerprint", "component_id", "n_words", "fail_bits", "kept", "n_removed", "start", "length", "shard", "k1", "bucket")}
    docs = docs.withColumns({"n_chars": F.lit(7).cast("long")} | clash)
    seen = stages(spark, docs, sf)
    assert all(d.columns == docs.columns and d.filter("size <> 'own' OR n_words <> 'own' OR kept <> 'own'").count() == 0 for d in seen[:-1])
    assert sorted(str(r.doc_id) for r in seen[2].collect()) == ["3", "None"]
    assert all(d.count() == 0 for d in stages(spark, docs.limit(0), sf))
