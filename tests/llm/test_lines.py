"""Line dedup against SQL and brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from contactweave.llm import line_dedup, registry

EDGES = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string"


def naive(rows):
    """(doc_id, lines, dropped lines, text kept) of each row."""
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(EDGES))
    place = lambda d: (d is None, d or 0)
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, place(doc)), place(doc))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == place(doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def found(df, **more):
    rows = line_dedup.keep_bitmaps(df, **more)
    return [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows.withColumn("kept", line_dedup.kept_text(F.col("text"), F.col("keep"))).collect()]


def by_all(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *map(str, r)))


def test_sql(spark, sf, same_as_sql):
    same_as_sql(registry.QUERIES["op11_first_lines"](spark, sf), registry.ORACLES["op11_first_lines"])


def test_whole_query_by_definition(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in naive(docs)]
    assert by_all(tuple(r) for r in line_dedup.op11_first_lines(spark, sf).collect()) == by_all(want)


@pytest.mark.parametrize("hot", [1 << 14, 3])
def test_random_texts(spark, monkeypatch, hot):
    """Hot keys and the others alike, with nulls, repeated rows, rows of one id, and lines that differ in case or at their ends."""
    monkeypatch.setattr(line_dedup.repeats, "__defaults__", (hot,))
    rng = random.Random(hot)
    lines = ["", " ", "short", "exactly 10", "Exactly 10\r", "\t exactly 10 ", "é" * 9, "É" * 10, "é" * 10, "a line that is long enough", "A LINE that is long enough\x0b", "another one, also long"]
    texts = [None, "", "\n", "\n\n", *("\n".join(rng.choices(lines, k=rng.randrange(1, 150))) for _ in range(60))]
    rows = [(rng.choice([None, 1, 2, 3, *range(-9, 40)]), rng.choice(texts)) for _ in range(150)]
    df = spark.createDataFrame(rows + rows[:9], DOCS).withColumns({"keep": F.lit("own"), "n_lines": F.lit("own"), "line": F.lit(1), "k1": F.lit(2)}).repartition(5)
    assert by_all(found(df)) == by_all(naive(rows + rows[:9]))
    if hot == 3:
        keys = line_dedup.stored(line_dedup.line_keys(df), "lines")
        assert keys.groupBy("h1").count().filter(F.col("count") * hot > keys.count()).count() == 1


def test_long_text_and_bitmaps(spark):
    many = "\n".join(f"line number {k}" for k in range(200_000))
    rows = [(5, many), (2, "line number 70\nLine Number 199999"), (9, many + "\n" + "x" * 2_000_000)]
    df = spark.createDataFrame(rows, DOCS)
    assert by_all(found(df)) == by_all(naive(rows))
    bits = {r.doc_id: r.keep for r in line_dedup.keep_bitmaps(df).collect()}
    assert bits[2] == [] and [w.word for w in bits[5]] == [1, 3124] and ~bits[5][0].bits == 1 << 6 and len(bits[9]) == 3125


def test_empty_and_other_keys(spark):
    assert line_dedup.keep_bitmaps(spark.createDataFrame([], DOCS)).count() == 0
    named = spark.createDataFrame([("b", "a line of more than ten"), ("a", "A line of more than TEN ")], "doc_id string, text string")
    assert by_all(found(named)) == [("a", 1, 0, "A line of more than TEN "), ("b", 1, 1, "")]
    assert [r[2] for r in found(named, least=30)] == [0, 0]
