"""Quality rules as a bitmask ledger.

Each text is measured once; every rule is evaluated once on the measurements
and its failure becomes one bit. Policies are versioned sets of rules: applying
one, or asking what each of its rules removes, is bit arithmetic on the ledger
and never reads a text again.

Defined cases: a null text counts as empty (no words, fails ``few_words``);
repeated rows get equal ledger rows; an empty table gives an empty ledger; other
columns of the input are passed on, those named like a ledger column are replaced.
Windows of words are compared by their 64-bit hash inside one document.

Very long texts: a text's words are an array of its row, many times its size, so texts of
more than ``LONG`` bytes are measured as rows instead: cut into pieces that end where a
word (or a line) does, their words and lines hashed, and counted by aggregation and windows.
Both ways give the same figures; a long text needs memory for itself and one piece's words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.llm.common import BLANKS, WORD, stored, table

WINDOW = 5
#: Bytes of a text that is measured as rows; characters of its pieces.
LONG, PIECE = 1 << 22, 1 << 21
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"]


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # SQL over the measurements


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule(5, "capitals", "10 * n_capitals > 4 * word_chars"),
)
#: A policy names the rules that reject; versions are added, never changed.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "prose-1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "capitals"),
}


def mask(policy: str) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[policy])


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements of its text, all from built-in functions."""
    size = F.coalesce(F.octet_length(text), F.lit(0))
    long = stored(df.filter(size > LONG).withColumn("_cw_id", F.monotonically_increasing_id()), "long")
    if long.isEmpty():
        return _measured(df, text)
    return _measured(df.filter(size <= LONG), text).unionByName(_measured_long(long, text).select(*[c for c in df.columns if c not in MEASURES], *MEASURES))


def _symbols(t: Column) -> Column:
    return F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", ""))


def _capitals(t: Column) -> Column:
    return F.length(F.regexp_replace(t, r"[^A-Z]+", ""))


def _measured(df: DataFrame, text: str) -> DataFrame:
    """Texts whose words fit their row."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = f"size(_cw_words) - {WINDOW} + 1"
    window = ", ".join(f"_cw_words[i + {k}]" for k in range(WINDOW))
    out = df.withColumn("_cw_words", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
    out = out.withColumn("_cw_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)))
    out = out.withColumn("_cw_windows", F.expr(f"IF({n} > 1, transform(sequence(0, {n} - 1), i -> xxhash64({window})), CAST(array() AS array<bigint>))"))
    # Only texts in which some window repeats go on: windows sorted by hash, those beside an equal one, back in text order.
    out = out.withColumn("_cw_sorted", F.expr("IF(size(array_distinct(_cw_windows)) < size(_cw_windows), sort_array(transform(_cw_windows, (h, i) -> struct(h, i))), NULL)"))
    out = out.withColumn(
        "_cw_found",
        F.expr("""IF(_cw_sorted IS NULL, NULL, sort_array(transform(filter(sequence(0, size(_cw_sorted) - 1), j ->
            (j > 0 AND _cw_sorted[j].h = _cw_sorted[j - 1].h) OR (j < size(_cw_sorted) - 1 AND _cw_sorted[j].h = _cw_sorted[j + 1].h)), j -> _cw_sorted[j].i)))"""),
    )
    covered = f"""IF(_cw_found IS NULL, 0L, {WINDOW}L + aggregate(sequence(0, size(_cw_found) - 1), 0L, (n, j) ->
        n + IF(j = 0, 0, least({WINDOW}, _cw_found[j] - _cw_found[j - 1]))))"""
    values = {
        "n_words": F.size("_cw_words"),
        "word_chars": F.length(F.regexp_replace(t, BLANKS, "")),
        "n_symbols": _symbols(t),
        "n_lines": F.size("_cw_lines"),
        "n_dup_lines": F.size("_cw_lines") - F.size(F.array_distinct("_cw_lines")),
        "n_repeat_words": F.expr(covered),
        "n_capitals": _capitals(t),
    }
    # A generated row stands between the measurements and their readers: a filter on them must not be
    # pushed below, where each of its references would measure the text again.
    measured = F.explode(F.array(F.struct(*[v.cast("long").alias(k) for k, v in values.items()])))
    out = out.withColumn("_cw_measured", measured)
    return out.withColumns({k: F.col("_cw_measured")[k] for k in values}).drop("_cw_words", "_cw_lines", "_cw_windows", "_cw_sorted", "_cw_found", "_cw_measured")


def _parts(pieces: DataFrame, inside: str) -> tuple[DataFrame, DataFrame]:
    """What pieces (id, k, piece) hold between their first and last characters other than ``inside``, as (id, g, inner), and the runs of ``inside`` that pieces begin or end with, put together, as (id, g, whole, said).

    ``g`` is the order of both; the run g follows what is inside of g. ``said``: a word character is in it.
    """
    head = F.regexp_extract("piece", f"^{inside}*", 0)
    # From the end: a pattern that has to end there would be tried at every place.
    tail = F.reverse(F.regexp_extract(F.reverse("piece"), f"^{inside}*", 0))
    rows = pieces.withColumns({"head": head, "tail": tail}).withColumn("opens", (F.length("head") < F.length("piece")).cast("int"))
    rows = rows.withColumn("g", F.sum("opens").over(Window.partitionBy("id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    inner = rows.filter("opens = 1").select("id", "g", F.expr("substring(piece, length(head) + 1, length(piece) - length(head) - length(tail))").alias("inner"))
    ends = F.array(F.struct((F.col("g") - F.col("opens")).alias("g"), "k", F.lit(0).alias("side"), F.col("head").alias("part")), F.struct("g", "k", F.lit(1).alias("side"), F.when(F.col("opens") == 1, F.col("tail")).otherwise("").alias("part")))
    ends = rows.select("id", F.explode(ends).alias("x")).select("id", "x.*").filter("part <> ''")
    runs = ends.groupBy("id", "g").agg(F.array_sort(F.collect_list(F.struct("k", "side", "part"))).alias("x"), F.max(F.col("part").rlike(WORD)).alias("said"))
    return inner, runs.select("id", "g", F.array_join("x.part", "").alias("whole"), "said")


def _measured_long(long: DataFrame, text: str) -> DataFrame:
    """Texts whose words are rows; ``_cw_id`` tells the texts apart."""
    last = F.floor((F.length("t") - 1) / PIECE).cast("int")
    at = long.select(F.col("_cw_id").alias("id"), F.col(text).alias("t")).select("id", "t", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    pieces = stored(at.select("id", "k", F.substring("t", F.col("k") * PIECE + 1, F.lit(PIECE)).alias("piece")), "pieces")
    plain = pieces.groupBy("id").agg(F.sum(F.length(F.regexp_replace("piece", BLANKS, ""))).alias("word_chars"), F.sum(_symbols(F.col("piece"))).alias("n_symbols"), F.sum(_capitals(F.col("piece"))).alias("n_capitals"))

    hashes = lambda of: (F.xxhash64(of).alias("h1"), F.xxhash64(F.lit("second"), of).alias("h2"))
    inner, runs = _parts(pieces, r"[^\n]")
    lines = inner.select("id", F.explode(F.split("inner", "\n", -1)).alias("line")).filter(F.col("line").rlike(WORD)).select("id", *hashes("line"))
    alike = lines.unionByName(runs.filter("said").select("id", *hashes("whole"))).groupBy("id", "h1", "h2").agg(F.count("*").alias("n"))
    by_line = alike.groupBy("id").agg(F.sum("n").alias("n_lines"), F.sum(F.col("n") - 1).alias("n_dup_lines"))

    inner, runs = _parts(pieces, WORD[:-1])
    words = inner.select("id", "g", F.lit(0).alias("side"), F.posexplode(F.regexp_extract_all("inner", F.lit(WORD), F.lit(0))).alias("i", "word")).select("id", "g", "side", "i", F.xxhash64("word").alias("h"))
    words = words.unionByName(runs.select("id", "g", F.lit(1).alias("side"), F.lit(0).alias("i"), F.xxhash64("whole").alias("h")))
    along = Window.partitionBy("id").orderBy("g", "side", "i")
    ahead = [F.lead("h", k).over(along).alias(f"h{k}") for k in range(1, WINDOW)]
    words = words.select("id", "h", *ahead, F.row_number().over(along).alias("place"))
    window = F.when(F.col(f"h{WINDOW - 1}").isNotNull(), F.xxhash64("h", *[f"h{k}" for k in range(1, WINDOW)]))
    words = stored(words.select("id", "place", window.alias("window")), "words")
    often = stored(words.filter("window IS NOT NULL").groupBy("id", "window").agg(F.count("*").alias("n")).filter("n > 1").select("id", "window"), "often")
    next_ = F.lead("place").over(Window.partitionBy("id").orderBy("place"))
    covered = words.join(often, ["id", "window"], "left_semi").select("id", F.least(F.lit(WINDOW), F.coalesce(next_ - F.col("place"), F.lit(WINDOW))).alias("n"))
    by_word = words.groupBy("id").agg(F.count("*").alias("n_words"))

    # Every long text has pieces, so the others join theirs; stored, so that the texts themselves are joined once, to a table of known size.
    found = plain.join(by_line, "id", "left").join(by_word, "id", "left").join(covered.groupBy("id").agg(F.sum("n").alias("n_repeat_words")), "id", "left")
    found = stored(found.withColumnsRenamed({c: f"_cw_of_{c}" for c in found.columns}), "measures")
    out = long.drop(*MEASURES).join(found, F.col("_cw_id") == F.col("_cw_of_id"), "left")
    return out.withColumns({c: F.coalesce(f"_cw_of_{c}", F.lit(0)).cast("long") for c in MEASURES})


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements and ``fail_bits``: bit b is set where rule b fails."""
    bits: Column = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(df, text).withColumn("fail_bits", bits)


def passes(policy: str) -> Column:
    """True where no rule of the policy fails."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """One row a rule of the policy: documents it fails, and those that only it rejects (kept without it)."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    rules = [r for r in RULES if r.name in POLICIES[policy]]
    one = rows.agg(
        F.count("*").alias("n"),
        *[f.cast("long") for r in rules for f in (
            F.coalesce(F.sum(F.getbit(hit, F.lit(r.bit)).cast("long")), F.lit(0)).alias(f"{r.name}_fails"),
            F.count_if(hit == (1 << r.bit)).alias(f"{r.name}_only"),
        )],
    )
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"{r.name}_fails").alias("fails"), F.col(f"{r.name}_only").alias("only_it")) for r in rules])
    return one.select("n", F.explode(pairs).alias("x")).select("x.rule", "n", "x.fails", "x.only_it")


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base-1")).alias("base_failed"), (passes("base-1") & passes("prose-1")).alias("kept"), "fail_bits",
    )


OP3_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT r, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
d AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (SELECT r, sum(least(5, coalesce(nx - i, 5))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM d) GROUP BY r),
m AS (SELECT doc_id, len(ws)::bigint AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint AS n_symbols, len(ls)::bigint AS n_lines,
        (len(ls) - len(list_distinct(ls)))::bigint AS n_dup_lines, coalesce(n, 0)::bigint AS n_repeat_words,
        length(regexp_replace(text, '[^A-Z]+', '', 'g'))::bigint AS n_capitals FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, (n_words < 10)::bigint AS f0, (100 * n_repeat_words > 20 * n_words)::bigint AS f1, (10 * n_symbols > n_words)::bigint AS f2,
        (100 * n_dup_lines > 30 * n_lines)::bigint AS f3, (word_chars < 2 * n_words OR word_chars > 20 * n_words)::bigint AS f4,
        (10 * n_capitals > 4 * word_chars)::bigint AS f5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f0 + f1 > 0) AS base_failed,
    (f0 + f1 + f2 + f3 + f4 + f5 = 0) AS kept, f0 + 2 * f1 + 4 * f2 + 8 * f3 + 16 * f4 + 32 * f5 AS fail_bits FROM f
"""
