"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and
share all words by weight; a target stops at ``max_repeat`` times its source's
words and what is over goes to the others by weight. The level at which this
settles is found in closed form from running sums over the sources.

Sampling: each document of a source expects ``target / source words`` copies. A
running sum of these in an order by size, plus one offset per source, crosses a
number of integers at each document: so many copies are emitted. Neighbours in
the order have like sizes, so the words taken come near the target. Copies are
counted in units of 2**-20, in whole numbers, so reruns agree to the row.

Defined cases: a null text has size 0; a null source is a source of its own; a
source without words gets target 0 and no copies; repeated rows are separate
documents; an empty table gives an empty table. Output columns replace input
columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.llm.common import running_total, stored, table, word_count

UNIT = 1 << 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """One row a source, of columns ``_cw_source`` and ``size``: its words and its target.

    Only the per-source sums, one small row each, are ordered in one place.
    """
    by = sizes.groupBy("_cw_source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy("_cw_source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    by = by.select("_cw_source", "source_size", weight.cast("long").alias("w"), (F.col("source_size") * max_repeat).alias("cap"))
    # Sources fill up in the order of cap / weight; the level is the one that leaves the rest unfilled.
    order = Window.orderBy(F.col("cap") / F.col("w"), "_cw_source")
    full = Window.orderBy(F.col("cap") / F.col("w"), "_cw_source").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    by = by.withColumns({
        "total": F.sum("source_size").over(every), "before": F.coalesce(F.sum("cap").over(full), F.lit(0)),
        "left": F.sum("w").over(every) - F.coalesce(F.sum("w").over(full), F.lit(0)), "k": F.row_number().over(order),
    })
    level = (F.col("total") - F.col("before")) / F.col("left")
    by = by.withColumn("level", level).withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
    settled = F.min(F.when(F.col("fits"), F.struct("k", "level"))).over(every)
    target = F.when(F.col("k") < settled["k"], F.col("cap").cast("double")).otherwise(settled["level"] * F.col("w"))
    return by.select("_cw_source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def _digest(*parts: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, digits), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """Monotone in the size: sizes to 63 alone, then 16 classes an octave."""
    octave = F.length(F.bin(size)) - 1
    fine = F.expr("shiftright(size, length(bin(size)) - 5)").bitwiseAND(F.lit(15).cast("long"))
    return F.when(size < 64, size).otherwise(64 + (octave - 6) * 16 + fine).cast("int")


def salt_digits(rows: int) -> int:
    """Hexadecimal digits of an id's digest that part rows of one size: one up to 2**24 rows, one more for each 16 times as many."""
    return len(f"{rows >> 20:x}")


def mix(df: DataFrame, seed: int = 1, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, keep_text: bool = True) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target`` and ``copies``, the times the mix takes the document.

    Words are counted once: rows are stored with their sizes, without the text if ``keep_text`` is false.
    """
    sized = df.withColumns({
        "size": word_count(F.col("text")), "_cw_source": F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")),
        "_cw_id": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), "_cw_hash": F.xxhash64("text"), "_cw_one": F.lit(1).cast("long"),
    })
    rows = stored(sized if keep_text else sized.drop("text"), "sized")
    digits = salt_digits(rows.count())
    salt = F.conv(F.substring("_cw_id", 1, digits), 16, 10).cast("long")
    rows = rows.withColumn("_cw_bucket", size_class(F.col("size")).cast("long") * 16**digits + salt)
    targets = source_targets(rows.select("_cw_source", "size"), weights, max_repeat)
    step = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    start = _digest(F.col("_cw_source"), F.lit(f"/{seed}"), digits=5)
    targets = targets.select("_cw_source", "source_size", "target", step.alias("_cw_step"), start.alias("_cw_start"))
    ranked = running_total(rows, ["_cw_source"], "_cw_bucket", ["size", "_cw_id", "_cw_hash"], "_cw_one", "_cw_rank").join(targets, "_cw_source")
    # Every document of a source expects the same number of copies: the running sum before it is rank * step.
    low = F.expr(f"(_cw_start + _cw_rank * _cw_step) div {UNIT}")
    high = F.expr(f"(_cw_start + (_cw_rank + 1) * _cw_step) div {UNIT}")
    return ranked.withColumn("copies", (high - low).cast("int")).drop("_cw_source", "_cw_id", "_cw_hash", "_cw_bucket", "_cw_one", "_cw_rank", "_cw_step", "_cw_start")


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says."""
    return mixed.filter("copies > 0").withColumn("_cw_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_cw_copy")


def op10_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


OP10_SQL = rf"""
WITH r AS (SELECT doc_id, coalesce('0' || source, '1') AS s, md5(coalesce(doc_id::varchar, 'null')) AS m,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size FROM documents),
d AS (SELECT length(hex(count(*) >> 20)) AS d FROM r),
b AS (SELECT *, (CASE WHEN size < 64 THEN size ELSE 64 + (length(bin(size)) - 7) * 16 + ((size >> (length(bin(size)) - 5)) & 15) END) * (1::bigint << (4 * d)::int)
        + ('0x' || substr(m, 1, d))::bigint AS bucket FROM r, d),
k AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY bucket, size, m) - 1 AS rank FROM b),
a AS (SELECT s, sum(size)::bigint AS source_size, row_number() OVER (ORDER BY s) - 1 AS place FROM r GROUP BY s),
c AS (SELECT s, source_size, place % 3 + 1 AS w, 3 * source_size AS cap FROM a),
f AS (SELECT *, (SELECT sum(source_size)::bigint FROM c) AS total, (SELECT sum(w) FROM c) AS all_w,
        coalesce(sum(cap) OVER u, 0)::bigint AS before, coalesce(sum(w) OVER u, 0)::bigint AS gone, row_number() OVER (ORDER BY cap / w, s) AS k FROM c
        WINDOW u AS (ORDER BY cap / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - before)::double / (all_w - gone)::double AS level FROM f),
x AS (SELECT k AS xk, level AS xl FROM l WHERE level * w <= cap ORDER BY k LIMIT 1),
t AS (SELECT s, source_size, CASE WHEN k < xk THEN cap::double ELSE xl * w END AS target FROM l, x),
e AS (SELECT *, CASE WHEN source_size > 0 THEN round(target / source_size * {UNIT})::bigint ELSE 0 END AS step, ('0x' || substr(md5(s || '/1'), 1, 5))::bigint AS start FROM t),
o AS (SELECT doc_id, size, source_size, target, ((start + (rank + 1) * step) // {UNIT} - (start + rank * step) // {UNIT})::int AS copies FROM k JOIN e USING (s))
SELECT doc_id, size, source_size, target, (copies * size)::bigint AS taken, copies FROM o
"""
