"""Sharding, quality rules and mixing."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from contactweave.llm import mixing, quality, registry, sharding

ODD = [(1, None, "a"), (2, "", None), (3, "one two", "a"), (3, "one two", "a"), (None, "x " * 5000, "b"), (None, None, None), (9, "lo\nlo\n\nlo  \x0b é z", "b")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, source string").withColumns({"shard": F.lit("own"), "size": F.lit("own"), "slot": F.lit(-1)})


@pytest.mark.parametrize("name", ["op3_rule_ledger", "op10_systematic_mix"])
def test_sql(spark, sf, same_as_sql, name):
    same_as_sql(registry.QUERIES[name](spark, sf), registry.ORACLES[name])


def test_shards(spark, sf):
    got = sharding.op1_rendezvous_shards(spark, sf).collect()
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        assert (r["size"], r.text_crc32) == (len(docs[r.doc_id]) + 1, zlib.crc32(docs[r.doc_id])) and r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert 5 < sum(r.grown_shard == 8 for r in got) < 50


def naive_shard(key, shards):
    """The shard of the largest weight / -ln(u), u from 53 bits of a chained 64-bit hash of the shard's name and the key."""
    text = "\0null" if key is None else str(key)
    best = None
    for s, w in shards:
        seed = xxhash.xxh64_intdigest(f"shard {s}".encode(), 42)
        u = ((xxhash.xxh64_intdigest(text.encode(), seed) >> 11) + 0.5) / 2**53
        bid = w / -math.log(u)
        if best is None or bid > best[0]:
            best = bid, s
    return best[1]


@pytest.mark.parametrize("shards", [[(k, 1.0) for k in range(8)], [(k, 1.0) for k in range(9)], [(3, 0.5), (7, 2.0), (1, 1.0)], [(4, 1.0)]])
def test_shards_by_definition(spark, shards):
    keys = [None, -5, *range(2000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.s for r in df.select("k", sharding.rendezvous(F.col("k"), shards).alias("s")).collect()}
    assert got == {k: naive_shard(k, shards) for k in keys}


def test_shard_query_by_definition(spark, sf):
    eight = [(k, 1.0) for k in range(8)]
    for r in sharding.op1_rendezvous_shards(spark, sf).collect():
        assert (r.shard, r.grown_shard) == (naive_shard(r.doc_id, eight), naive_shard(r.doc_id, [*eight, (8, 1.0)]))


@pytest.mark.parametrize(("rows", "broadcast"), [(1 << 16, 1 << 17), (3, 1 << 17), (3, 0)])
def test_slots_whatever_the_buckets(spark, monkeypatch, rows, broadcast):
    for name, value in (("SLOT_BUCKETS", 2), ("BUCKET_ROWS", rows), ("BROADCAST", broadcast)):
        monkeypatch.setattr(sharding, name, value)
    out = sharding.shard_rows(spark.range(500), "id", [(0, 1.0), (1, 2.0)]).collect()
    for s in (0, 1):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


def test_weighted_shards(spark):
    keys = spark.range(20000).select(F.col("id").alias("k"))
    share = Counter(r.s for r in keys.select(sharding.rendezvous(F.col("k"), [(0, 1.0), (1, 3.0)]).alias("s")).collect())
    assert abs(share[1] / 20000 - 0.75) < 0.02
    less = keys.select(sharding.rendezvous(F.col("k"), [(0, 1.0), (1, 3.0), (2, 2.0)]).alias("a"), sharding.rendezvous(F.col("k"), [(0, 1.0), (1, 3.0)]).alias("b"))
    assert less.filter("a <> 2 AND a <> b").count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("k"), [(0, 0.0)])


def test_shard_cases(spark, odd):
    out = sharding.shard_rows(odd, "doc_id", [(0, 1.0), (1, 1.0)], text="text").collect()
    assert len(out) == len(ODD)
    for s in (0, 1):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert len({r.shard for r in out if r.doc_id == 3}) == 1
    assert sharding.shard_rows(odd.limit(0), "doc_id", [(0, 1.0)]).count() == 0


def naive_repeats(words):
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(hit)


def test_ledger_cases(spark, odd):
    texts = ["a b c d e " * 3, "a b c d e f a b c d e", "x x x x x x", "#" * 9 + " <a>", "A\nA\n \nA b\n"]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(20 + k, t) for k, t in enumerate(texts)], "doc_id long, text string")).withColumn("n_words", F.lit("own"))
    for r in quality.ledger(df).collect():
        words = (r.text or "").encode().split()
        lines = [x for x in (r.text or "").split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars) == (len(words), sum(len(w.decode()) for w in words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "") and r.n_repeat_words == naive_repeats(words)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert bool(r.fail_bits & 1) == (len(words) < 10)
    assert quality.ledger(df.limit(0)).count() == 0


def test_ablation(spark, sf):
    rows = quality.ledger(spark.read.parquet(f"{sf}/documents.parquet"))
    bits = [r.fail_bits for r in rows.select("fail_bits").collect()]
    got = {r.rule: (r.n, r.fails, r.only_it) for r in quality.ablation(rows, "prose-1").collect()}
    for rule in quality.RULES:
        assert got[rule.name] == (len(bits), sum(b >> rule.bit & 1 for b in bits), sum(b == 1 << rule.bit for b in bits))
    assert rows.filter(quality.passes("prose-1")).count() == sum(b == 0 for b in bits)


def naive_targets(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    left = float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total, share = sum(weight[s] for s in open_), left
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += share * weight[s] / total
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
        open_ = {s for s in open_ if target[s] < most * sizes[s]}
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 5}, {"a": 1, "b": 1, "c": 1, "d": 500}, {"a": 0, "b": 7}, {"x": 3}, {"a": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([("1" if s is None else "0" + s, n) for s, n in sizes.items()], "_cw_source string, size long")
    got = {r._cw_source: r.target for r in mixing.source_targets(rows).collect()}
    for s, t in naive_targets(sizes).items():
        assert got["1" if s is None else "0" + s] == pytest.approx(t)


def test_mix(spark, sf):
    got = mixing.op10_systematic_mix(spark, sf).collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r.taken <= 3 * r["size"] for r in got)
    for s in set(source.values()):
        own = [r for r in got if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1.5 * max(r["size"] for r in own)


def test_salt_digits():
    assert [mixing.salt_digits(n) for n in (0, 1 << 20, (1 << 24) - 1, 1 << 24, (1 << 28) - 1, 1 << 28, 1 << 36)] == [1, 1, 1, 2, 2, 3, 5]


def test_mix_cases(spark, odd):
    frame = odd.withColumns({"target": F.lit("own"), "copies": F.lit("own")})
    got = mixing.mix(frame)
    assert got.count() == len(ODD)
    assert sorted(map(str, mixing.mix(frame.repartition(5)).collect())) == sorted(map(str, got.collect()))
    assert mixing.emit(got).count() == sum(r.copies for r in got.collect())
    assert mixing.mix(frame.limit(0)).count() == 0


def plain_measures(text):
    """The ledger's measurements, by definition."""
    blanks = "\t\n\x0b\x0c\r "
    words = re.findall(f"[^{blanks}]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(blanks)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(covered), sum("A" <= c <= "Z" for c in text or ""))


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_long_texts_as_rows(spark, monkeypatch, piece):
    """Texts measured as rows, cut into pieces of any size, have the figures of the definition; short and long ones stand together."""
    monkeypatch.setattr(quality, "LONG", 30)
    monkeypatch.setattr(quality, "PIECE", piece)
    rng = random.Random(piece)
    parts = ["a", "b", "Éa", "#", "word" * 9, " ", "\n", "\t", "\x0b", "　", "same line here\n", "one two three four five "]
    texts = ["".join(rng.choices(parts, k=rng.randrange(80))) for _ in range(40)] + ["a b " * 40, "x" * 200, "\n" * 200, " " * 50, "", None, "é\n" * 60]
    rows = [(k % 9, t) for k, t in enumerate(texts + texts[:5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_words": F.lit("own"), "id": F.lit(1), "piece": F.lit(2)}).repartition(3)
    got = quality.measure(df)
    assert got.columns == [*[c for c in df.columns if c != "n_words"], *quality.MEASURES] or set(got.columns) == {*df.columns, *quality.MEASURES}
    assert Counter((r.text, *(r[c] for c in quality.MEASURES)) for r in got.collect()) == Counter((t, *plain_measures(t)) for _, t in rows)
