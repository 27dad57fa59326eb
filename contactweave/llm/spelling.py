"""Grouping of spelling variants by a dictionary of trie-node pairs.

Words that are one inserted, deleted or replaced code point apart share all before the
place and all behind it. The words' prefixes are the nodes of a trie and their suffixes
those of a trie of reversed words; both tries' nodes get numbers, so what stands around a
place is a pair of whole numbers. With prefix p(i) and suffix s(i) of a word at place i,
two words differ in one replaced code point if they share (p(i), s(i + 1)), the pair that
skips place i, and a word is another with place i left out if its (p(i), s(i + 1)) is the
other's (p(i), s(i)), the pair at which one is inserted. So one join on the pairs gives
exactly the neighbours. A pair's skipping words differ in one letter, and at most one word
is cut there, so no pair has more words than the alphabet has letters, and a group can't
grow with the data. Of a run of equal letters only the first is left out, so that no
neighbour is found twice.

Numbers: all words have ``HEAD`` letters and more, a letter being a byte of Latin-1. A node
of ``HEAD`` letters and fewer is numbered by its letters. Deeper nodes are shared only by
words of one head: these meet in one task, sorted, which keeps one path of the trie and
numbers nodes as they come, so it holds no more than a word. The reversed trie alike.

Forms: a word's form has ten times its count or more, so chains of forms are short (no
longer than the digits of the largest count), and a few rounds of doubled steps end them.

Defined cases: a null or empty text has no words; a null doc_id counts as empty in the hash;
rows of one doc_id are counted one by one; words are counted over all rows; very long runs
are words like others, in memory of their length; without words there are no rows.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactweave.llm.common import stored, table

LETTERS = r"[A-Za-zÀ-ÿ]"
#: Code points of the shortest word, its least count, and how much more often a form is.
SHORTEST, LEAST, TIMES = 7, 2, 10
#: Letters of a node that is numbered by them: with a leading 1 they fit below 2**57.
HEAD = 7
#: One run in so many, by the hash of document and run, loses a code point.
MUTATED = 31
#: Nodes a task holds before it hands rows on.
HELD = 1 << 18
FORWARD = "wid long, n long, word string, heads binary"
PAIRS = "p long, s long, skips boolean, leads boolean, wid long, n long"


def spelled(doc_id: Column, run: Column) -> Column:
    """The word a run stands for: lower case, and of one run in ``MUTATED`` without the code point its hash names."""
    low = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, string.ascii_uppercase, string.ascii_lowercase))
    hashed = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), low), "UTF-8"))
    # A list of one element names the parts, so that none is made twice.
    both = F.array(F.struct(low.alias("w"), hashed.alias("h")))

    def of(x: Column) -> Column:
        at = (x["h"] % F.length(x["w"])).cast("int")
        return F.when(x["h"] % MUTATED == 0, F.concat(F.substring(x["w"], F.lit(1), at), F.substr(x["w"], at + 2))).otherwise(x["w"])

    return F.transform(both, of)[0]


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n) of the words of a length and count of at least so much; counted with map-side combine."""
    # Runs that are too short are no matches, and a match that is long enough is a whole run.
    runs = df.select(F.col(key).alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))).alias("run"))
    words = runs.select(spelled(F.col("id"), F.col("run")).alias("word")).filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


class Path:
    """Numbers of the nodes on the way to the last word of a task's sorted words."""

    def __init__(self, task: int):
        self.last, self.nodes, self.next = b"", [], (1 << 62) + (task << 36)

    def to(self, word: bytes) -> np.ndarray:
        """Numbers of the word's prefixes, from the empty one to the word itself."""
        n = min(len(word), len(self.last))
        differs = int.from_bytes(word[:n]) ^ int.from_bytes(self.last[:n])
        same = n - (differs.bit_length() + 7) // 8
        short = [int.from_bytes(b"\1" + word[:k]) for k in range(min(HEAD, len(word)) + 1)]
        kept = self.nodes[: same + 1] if same > HEAD else short
        new = len(word) + 1 - len(kept)
        self.last, self.nodes = word, kept + list(range(self.next, self.next + new))
        self.next += new
        return np.array(self.nodes, dtype=np.int64)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = Path(TaskContext.get().partitionId())
    for batch in batches:
        begin, held, nodes = 0, 0, []
        for k, word in enumerate(batch.column("word").to_pylist()):
            nodes.append(path.to(word.encode("latin-1")).tobytes())
            held += len(word) + 1
            if held >= HELD or k + 1 == batch.num_rows:
                some = batch.slice(begin, k + 1 - begin)
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("wid", "n", "word")), pa.array(nodes, pa.binary())], names=[x.split()[0] for x in FORWARD.split(", ")])
                begin, held, nodes = k + 1, 0, []


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PAIRS of all places of words that come in the order of their reversed letters."""
    path = Path(TaskContext.get().partitionId())
    names = [x.split()[0] for x in PAIRS.split(", ")]

    def rows(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)

    for batch in batches:
        columns, held = [[] for _ in names], 0
        for wid, n, word, heads in zip(*(batch.column(x.split()[0]).to_pylist() for x in FORWARD.split(", ")), strict=True):
            raw = word.encode("latin-1")
            p, s = np.frombuffer(heads, dtype=np.int64), path.to(raw[::-1])[::-1]
            letters = np.frombuffer(raw, dtype=np.uint8)
            leads = np.concatenate([[True], letters[1:] != letters[:-1]])
            size = 2 * len(raw) + 1
            skips = np.arange(size) < len(raw)
            parts = (np.concatenate([p[:-1], p]), np.concatenate([s[1:], s]), skips, np.concatenate([leads, np.ones(len(raw) + 1, dtype=bool)]), np.full(size, wid), np.full(size, n))
            for column, part in zip(columns, parts, strict=True):
                column.append(part)
            held += size
            if held >= HELD:
                yield rows(columns)
                columns, held = [[] for _ in names], 0
        if held:
            yield rows(columns)


def node_pairs(words: DataFrame) -> DataFrame:
    """(p, s, skips, leads, wid, n) of every place of the words (wid, word, n): the pairs that skip a place (``leads``: the first of its run of equal letters), and those between places."""
    heads = words.select("wid", "n", "word").withColumn("head", F.substring("word", 1, HEAD)).repartition("head").sortWithinPartitions("head", "word").drop("head")
    forward = heads.mapInArrow(_forward, FORWARD).withColumn("back", F.reverse("word"))
    # Binary order of reversed letters: of Latin-1 that is UTF-8's.
    tails = forward.withColumn("tail", F.substring("back", 1, HEAD)).repartition("tail").sortWithinPartitions("tail", "back").drop("tail", "back")
    return tails.mapInArrow(_pairs, PAIRS)


def neighbours(words: DataFrame) -> DataFrame:
    """(wid, other, other_n): every two words (wid, word, n) exactly one code point apart, both ways, each once."""
    lists = node_pairs(words).groupBy("p", "s").agg(F.collect_list(F.struct("wid", "n", "skips", "leads")).alias("x")).filter("size(x) > 1")
    # No list is longer than the alphabet and one.
    met = lists.select(F.explode("x").alias("a"), "x").select("a", F.explode("x").alias("b")).filter("a.wid <> b.wid")
    replaced = F.col("a.skips") & F.col("b.skips")
    left_out = (F.col("a.skips") != F.col("b.skips")) & F.col("a.leads") & F.col("b.leads")
    return met.filter(replaced | left_out).select(F.col("a.wid").alias("wid"), F.col("b.wid").alias("other"), F.col("b.n").alias("other_n"))


def numbered(counts: DataFrame) -> DataFrame:
    """(wid, word, n), stored; ids follow the words' code-point order."""
    placed = counts.repartitionByRange("word").sortWithinPartitions("word")
    return stored(placed.select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "words")


def roots_of(forms: DataFrame, most: int) -> DataFrame:
    """(wid, root): the last form of each word (wid, form), if counts up to ``most`` bound the chains."""
    steps = 1 + math.floor(math.log(max(most, 1), TIMES))
    for _ in range(max(0, math.ceil(math.log2(max(steps, 1))))):
        on = forms.select(F.col("wid").alias("at"), F.col("form").alias("further"))
        forms = stored(forms.join(on, F.col("form") == F.col("at"), "left").select("wid", F.coalesce("further", "form").alias("form")), "roots")
    return forms.withColumnRenamed("form", "root")


def variants(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n)."""
    words = numbered(counts)
    near = neighbours(words).groupBy("wid").agg(F.count("*").alias("n_near"), F.max(F.struct("other_n", (-F.col("other")).alias("less"))).alias("best"))
    rows = words.join(near, "wid", "left").withColumn("is_form", F.col("best.other_n") >= times * F.col("n"))
    rows = rows.select("wid", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("is_form"), -F.col("best.less")).alias("form_id"), F.when(F.col("is_form"), F.col("best.other_n")).alias("form_n"))
    rows = stored(rows, "near")
    most = rows.agg(F.max("n")).first()[0] or 0
    roots = roots_of(stored(rows.filter("form_id IS NOT NULL").select("wid", F.col("form_id").alias("form")), "forms"), most)
    name = lambda of, out: words.select(F.col("wid").alias(of), F.col("word").alias(out))
    rows = rows.join(roots.withColumnRenamed("root", "root_id"), "wid", "left").join(name("form_id", "form"), "form_id", "left").join(name("root_id", "last"), "root_id", "left")
    return rows.select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def op12_trie_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


# CRC-32 from its polynomial, a byte at a time; the letters' UTF-8 bytes from their code points.
OP12_SQL = rf"""
WITH RECURSIVE bits AS (SELECT range AS b, range::bigint AS c, 0 AS i FROM range(256) UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
runs AS MATERIALIZED (SELECT id, run, count(*) AS m FROM (SELECT coalesce(doc_id::varchar, '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run FROM documents) WHERE length(run) >= {SHORTEST} GROUP BY 1, 2),
utf AS (SELECT id, run, m, flatten(list_transform(string_split(id || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::bigint] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)]::bigint[] END)) AS bytes FROM runs),
hashed AS (SELECT run, m, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM utf, crc),
words AS MATERIALIZED (SELECT word, sum(m)::bigint AS n FROM (SELECT m, CASE WHEN h % {MUTATED} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
    WHERE length(word) >= {SHORTEST} GROUP BY 1 HAVING sum(m) >= {LEAST}),
places AS MATERIALIZED (SELECT word, n, i, word[:i] || '_' || word[i + 2:] AS skipped, word[:i] || word[i + 2:] AS shorter FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (SELECT a.word, b.word AS other, b.n AS other_n FROM places a JOIN places b ON a.skipped = b.skipped AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM places a JOIN words b ON a.shorter = b.word UNION SELECT b.word, a.word, a.n FROM places a JOIN words b ON a.shorter = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY 1),
forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {TIMES} * n THEN other END AS form, CASE WHEN other_n >= {TIMES} * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT chain.word, form FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NOT NULL)
SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain ON chain.word = f.word JOIN forms l ON l.word = chain.root AND l.form IS NULL
"""
