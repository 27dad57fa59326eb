"""Spelling variants against SQL and brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contactweave.llm import registry, spelling

COUNTS = "word string, n long"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def naive_counts(rows, least=2):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            k = h % len(run)
            seen[run if h % 31 else run[:k] + run[k + 1 :]] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= least}


def naive(counts, pairs=None):
    by = {w: set() for w in counts}
    for a, b in pairs if pairs is not None else ((a, b) for a, b in itertools.combinations(counts, 2) if near(a, b)):
        by[a].add(b)
        by[b].add(a)
    form = {}
    for w, others in by.items():
        if others:
            top = min(others, key=lambda o: (-counts[o], o))
            if counts[top] >= 10 * counts[w]:
                form[w] = top
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(by[w]), counts[form[w]] if w in form else None))
    return out


def rows_of(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(set(got)) == len(got)
    return set(got)


def test_sql(spark, sf, same_as_sql):
    same_as_sql(registry.QUERIES["op12_trie_pairs"](spark, sf), registry.ORACLES["op12_trie_pairs"])


def test_whole_query_by_definition(spark, sf):
    counts = naive_counts([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    got = rows_of(spelling.op12_trie_pairs(spark, sf))
    assert got == naive(counts) and any(r[1] for r in got)


def test_counts_of_odd_texts(spark):
    rng = random.Random(3)
    pieces = ["Straße", "ÀÉÎõü÷×ÿ", "ABCDEFGH", "abcdefgh", "abcdefg", "abcdef", "ſtrange", "naïveté", "x" * 3000, "¿", "é", "1", "\n", " "]
    rows = [(rng.choice([None, -1, *range(50)]), rng.choice([None, "", "".join(rng.choices(pieces, k=rng.randrange(200)))])) for _ in range(120)]
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string").withColumns({"word": F.lit("own"), "run": F.lit(1)}).repartition(5)
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == naive_counts(rows + rows[:5])


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefghijÿ"])
def test_random_words(spark, letters):
    """Words of few letters, so that runs of equal letters, shared heads and tails, ties and long chains of forms are common."""
    rng = random.Random(len(letters))
    counts = {}
    for _ in range(400):
        base = "".join(rng.choices(letters, k=rng.randrange(7, 12)))
        for k in range(4):
            counts.setdefault(base, 2 * 10 ** rng.choice([0, 0, 1, 2, 3, 4]) + rng.randrange(2))
            at = rng.randrange(len(base))
            base = base[:at] + rng.choice([base[at + 1 :], rng.choice(letters) + base[at:], rng.choice(letters) + base[at + 1 :]]) if len(base) > 7 else base + rng.choice(letters)
    df = spark.createDataFrame(list(counts.items()), COUNTS).withColumn("wid", F.lit("own"))
    assert rows_of(spelling.variants(df.repartition(4))) == naive(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2000, "aaaabbbb": 20_000, "aaabbbbb": 200_000, "zzzzzzz": 3, "zzzzzzzb": 30, "zzzzzzza": 30, "alone" + "x" * 9: 5}
    got = {r[0]: r for r in rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), COUNTS)))}
    assert got["aaaaaaa"][1:3] == ("aaaaaaab", "aaabbbbb") and got["zzzzzzz"][1] == "zzzzzzza" and set(got.values()) == naive(counts)


def test_very_long_words_and_none(spark):
    long = "ab" * 150_000
    counts = {long: 400, long[:1000] + long[1001:]: 3, long[:-1] + "c": 4, long + "b": 50}
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), COUNTS)))
    pairs = [(long, w) for w in counts if w != long] + [(long[:-1] + "c", w) for w in ()]
    assert got == naive(counts, pairs)
    assert spelling.variants(spark.createDataFrame([], COUNTS)).count() == 0
    assert spelling.word_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
