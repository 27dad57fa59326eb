"""Removal of lines that an earlier document holds too, as bitmaps of the lines that stay.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of
``LEAST`` code points and more become 128 bits of hash, stored once beside document and
position. They are dealt by ranges of the hash and sorted by hash, document and position,
so the first occurrence of a key streams past before the others; whatever comes from
another document than the first goes. Places that go are gathered to words of 64 lines
and a document's bitmap lists the words that lose a line.

Hot keys: a key with over 1/``HOT`` of all lines would fill a task. There are fewer than
``HOT`` of these, a bound that holds for any table, so they may be broadcast: their first
documents are minima with map-side combine, looked up where the lines are stored, and
their lines are never shuffled.

Defined cases: a null or empty text is one empty line; rows of one doc_id are one document
(none of its own lines goes because of another row of it), a null doc_id is the largest of
all, and rows of null doc_id are one document; line feeds alone end lines, so a carriage
return is white space at a line's end; a document may lose all lines, which leaves an empty
text; rows equal in doc_id and text have equal bitmaps; an empty table gives an empty table;
other columns are passed on, those called ``n_lines``, ``n_dropped`` or ``keep`` replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.llm.common import stored, table

LEAST = 10
#: A key is hot if it has more than this share of all lines, as 1 / HOT.
HOT = 1 << 14
EDGES = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, any other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with 128 bits that tell its rows apart by (key, text)."""
    return df.withColumns({"_cw_k1": F.xxhash64(key, text), "_cw_k2": F.xxhash64(F.lit("second"), text, key)})


def line_keys(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(k1, k2, doc, pos, h1, h2): a row for each line whose key is long enough."""
    rows = _row_key(df.select(key, text), key, text).select(F.col("_cw_k1").alias("k1"), F.col("_cw_k2").alias("k2"), F.col(key).alias("doc"), F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(EDGES))).filter(F.length("line") >= least).withColumn("line", lower_ascii(F.col("line")))
    return rows.select("k1", "k2", "doc", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def repeats(lines: DataFrame, hot: int = HOT) -> DataFrame:
    """(k1, k2, pos) of the lines whose key an earlier document has. ``lines`` is read several times."""
    counts = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    often = stored(counts.filter(F.col("n") * hot > lines.agg(F.count("*")).scalar()).select("h1", "h2"), "often")
    # At most ``hot`` keys.
    rows = lines.join(F.broadcast(often), ["h1", "h2"], "left_anti")
    order = Window.partitionBy("h1", "h2").orderBy(F.asc_nulls_last("doc"), "k1", "k2", "pos")
    # Ranges of (h1, h2) are groups of both, so the window sorts the ranges and shuffles nothing more.
    cold = rows.repartitionByRange("h1", "h2").withColumn("first", F.first("doc").over(order))
    found = lines.join(F.broadcast(often), ["h1", "h2"])
    # Nulls last: the least of a key's documents is null only if all are.
    firsts = stored(found.groupBy("h1", "h2").agg(F.min("doc").alias("first")), "firsts")
    both = cold.select("k1", "k2", "pos", "doc", "first").unionByName(found.join(F.broadcast(firsts), ["h1", "h2"]).select("k1", "k2", "pos", "doc", "first"))
    return both.filter(~F.col("doc").eqNullSafe(F.col("first"))).select("k1", "k2", "pos")


def keep_bitmaps(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``df`` with ``n_lines``, ``n_dropped`` and ``keep``: the words (word, bits) of 64 lines that lose one, in order; bit b stands for line 64 * word + b and is set if it stays.

    Words that aren't listed keep all their lines.
    """
    lines = stored(line_keys(df, key, text, least), "lines")
    words = repeats(lines).groupBy("k1", "k2", F.expr("CAST(pos DIV 64 AS INT)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(pos % 64 AS INT))")).alias("gone"))
    lists = words.groupBy("k1", "k2").agg(F.sum(F.bit_count("gone").cast("long")).alias("dropped"), F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("bitmap"))
    # Stored: the join has plain shuffles on both sides, and rows that are repeated very often can be split.
    lists = stored(lists.withColumnsRenamed({c: f"_cw_of_{c}" for c in lists.columns}), "bitmaps")
    rows = _row_key(df.drop("n_lines", "n_dropped", "keep"), key, text)
    rows = rows.join(lists, (F.col("_cw_k1") == F.col("_cw_of_k1")) & (F.col("_cw_k2") == F.col("_cw_of_k2")), "left")
    none = F.array().cast("array<struct<word: int, bits: bigint>>")
    out = rows.withColumns({"n_lines": F.size(lines_of(F.col(text))).cast("long"), "n_dropped": F.coalesce("_cw_of_dropped", F.lit(0).cast("long")), "keep": F.coalesce("_cw_of_bitmap", none)})
    return out.drop("_cw_k1", "_cw_k2", *lists.columns)


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that stay, joined by line feeds; linear in the text and its bitmap."""
    bit = lambda w, b: F.getbit(w["bits"], b) == 0
    gone = F.flatten(F.transform(keep, lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: bit(w, b)), lambda b: w["word"] * 64 + b)))

    def slices(x: Column) -> Column:
        """What stands between the places that go."""
        begin = lambda i: F.when(i == 0, 0).otherwise(F.get(x["gone"], i - 1) + 1)
        end = lambda i: F.coalesce(F.get(x["gone"], i), F.size(x["lines"]))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["gone"])), lambda i: F.slice(x["lines"], begin(i) + 1, end(i) - begin(i))))

    # A list of one element names both parts, so that neither is made again for every slice.
    both = F.array(F.struct(lines_of(text).alias("lines"), gone.alias("gone")))
    return F.when(F.size(keep) == 0, F.coalesce(text, F.lit(""))).otherwise(F.transform(both, lambda x: F.array_join(slices(x), "\n"))[0])


def op11_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(kept_text(F.col("text"), F.col("keep")), "UTF-8"), 256).alias("kept_sha256"))


OP11_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM t),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
f AS (SELECT *, length(key) >= {LEAST} AND doc_id IS DISTINCT FROM first_value(doc_id) OVER (PARTITION BY key ORDER BY doc_id NULLS LAST) AS gone FROM k)
SELECT any_value(doc_id) AS doc_id, count(*)::bigint AS n_lines, count_if(gone)::bigint AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM f GROUP BY r
"""
