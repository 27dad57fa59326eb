"""Allele tables: rows of contigs that are copies of each other and must not be joined."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactweave.functions.storage import stored


def members(rows: DataFrame) -> DataFrame:
    """(row_id, contig_id) of the allele rows (row_id, contig_ids)."""
    return rows.select("row_id", F.explode("contig_ids").alias("contig_id")).distinct()


def rows_of(rows: DataFrame) -> DataFrame:
    """(contig_id, rows): the sorted rows that a contig has a part in."""
    return members(rows).filter("row_id IS NOT NULL AND contig_id IS NOT NULL").groupBy("contig_id").agg(F.sort_array(F.collect_set("row_id")).alias("rows"))


def _alike(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, contig_id), and (rows, all): the sorted contigs of each set of rows that a contig has. Contigs with the same rows share one list."""
    of = rows_of(rows)
    each = rows.select("row_id", F.array_compact("contig_ids").alias("ids"))
    sets = of.select("rows").distinct().select("rows", F.explode("rows").alias("row_id")).join(each, "row_id")
    return of.select("rows", "contig_id"), sets.groupBy("rows").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("all"))


#: Tasks the slices are dealt to at least.
DEAL = 16
#: Contigs with the same rows that get their list from one row of it.
SLICE = 64


def _lists(rows: DataFrame, whole, without) -> DataFrame:
    """(contig_id, others): ``without(whole(all), contig_id)`` for every contig that isn't alone in its rows.

    The list of each set of rows is made once and meets slices of its contigs, not each contig; a slice's
    rows are made by one task, and slices are dealt to tasks by their number, whatever their size.
    """
    of, lists = _alike(rows)
    slices = of.withColumn("slice", F.floor((F.row_number().over(Window.partitionBy("rows").orderBy("contig_id")) - 1) / SLICE))
    slices = slices.groupBy("rows", "slice").agg(F.collect_list("contig_id").alias("ids"))
    met = slices.join(lists.filter(F.size("all") > 1).select("rows", whole(F.col("all")).alias("all")), "rows")
    tasks = 4 * max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), DEAL)
    dealt = met.repartition(tasks, "rows", "slice")
    return dealt.select("all", F.explode("ids").alias("contig_id")).select("contig_id", without(F.col("all"), F.col("contig_id")).alias("others"))


def conflicts(rows: DataFrame) -> DataFrame:
    """(contig_id, other_ids): for each contig the sorted contigs that share a row with it."""
    return _lists(rows, lambda x: x, F.array_remove).withColumnRenamed("others", "other_ids")


def conflict_texts(rows: DataFrame) -> DataFrame:
    """(contig_id, other_ids) as ``conflicts``, the contigs as text joined by commas: a contig is cut out of its rows' text."""
    text = lambda x: F.concat(F.lit(","), F.array_join(x.cast("array<string>"), ","), F.lit(","))
    cut = lambda x, own: F.replace(x, F.concat(F.lit(","), own.cast("string"), F.lit(",")), F.lit(","))
    found = _lists(rows, text, cut)
    return found.select("contig_id", F.substring("others", F.lit(2), F.length("others") - 2).alias("other_ids"))


def prune_within_rows(counts: DataFrame, rows: DataFrame) -> DataFrame:
    """Link counts (lo, hi, pairs) without those between two contigs of one allele row.

    Driven from the links, so a row's contigs are never paired with each other.
    """
    m = members(rows)
    a, b = (m.select("row_id", F.col("contig_id").alias(c)) for c in ("lo", "hi"))
    shared = counts.select("lo", "hi").join(a, "lo").join(b, ["row_id", "hi"]).select("lo", "hi").distinct()
    return counts.join(shared, ["lo", "hi"], "left_anti")


def row_candidates(counts: DataFrame, rows: DataFrame) -> DataFrame:
    """(row_i, row_j, contig_i, contig_j, pairs), row_i < row_j: links between contigs that only one of two rows has.

    Driven from the links; rows without a link never meet.
    """
    m = members(rows)
    both = counts.select(F.explode(F.array(F.struct(F.col("lo").alias("i"), F.col("hi").alias("j")), F.struct(F.col("hi").alias("i"), F.col("lo").alias("j")))).alias("x"), "pairs")
    met = both.select(F.col("x.i").alias("contig_i"), F.col("x.j").alias("contig_j"), "pairs")
    met = met.join(m.select(F.col("row_id").alias("row_i"), F.col("contig_id").alias("contig_i")), "contig_i")
    met = met.join(m.select(F.col("row_id").alias("row_j"), F.col("contig_id").alias("contig_j")), "contig_j").filter("row_i < row_j")
    for row, contig in (("row_j", "contig_i"), ("row_i", "contig_j")):
        met = met.join(m.select(F.col("row_id").alias(row), F.col("contig_id").alias(contig)), [row, contig], "left_anti")
    return met.select("row_i", "row_j", "contig_i", "contig_j", "pairs")


#: Links left below which one task settles the rest; each is a row of nine numbers.
REST = 50_000
#: Links of one pair of rows that one task may go through, and the part of all links that a wave must settle.
MOST, SHARE = 4_000_000, 64


def _greedy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links dropped when the links left are gone through in order."""
    parts = list(batches)
    if not parts:
        return
    left = pd.concat(parts, ignore_index=True).sort_values(["row_i", "row_j", "pairs", "lo", "hi"], ascending=[True, True, False, True, True])
    gone: set[tuple[int, int]] = set()
    used: set[tuple[int, int, int]] = set()
    for i, j, x, y, lo, hi, blocked in left[["row_i", "row_j", "contig_i", "contig_j", "lo", "hi", "blocked"]].itertuples(index=False):
        if (lo, hi) in gone:
            continue
        # The two sides of a pair of rows have no contig in common.
        if blocked or (i, j, x) in used or (i, j, y) in used:
            gone.add((lo, hi))
        else:
            used |= {(i, j, x), (i, j, y)}
    yield pd.DataFrame(sorted(gone), columns=["lo", "hi"])


def _settled(left: DataFrame) -> DataFrame:
    """``left`` with ``matched`` and ``dropped``, and whether the row shares a contig of its rows with a matched one (``hit``) or its link with a dropped one (``out``)."""
    sides = [Window.partitionBy("row_i", "row_j", f"contig_{s}") for s in "ij"]
    link = Window.partitionBy("lo", "hi")
    live = F.when(~F.col("blocked"), F.col("at"))
    rows = left.withColumn("first", F.min("at").over(link)).withColumns({f"first_{k}": F.min(live).over(w) for k, w in enumerate(sides)})
    now = F.col("at") == F.col("first")
    rows = rows.withColumns({"matched": now & ~F.col("blocked") & (F.col("at") == F.col("first_0")) & (F.col("at") == F.col("first_1")), "dropped": now & F.col("blocked")})
    hit = F.greatest(*[F.max("matched").over(w) for w in sides])
    return rows.withColumn("hit", hit).withColumn("out", F.max("dropped").over(link)).drop("first", "first_0", "first_1")


def _places() -> Column:
    """A link's pairs of rows in order, from the rows ``a`` of its low and ``b`` of its high contig; ``ahead`` if the low one is in the first. Pruned links have no row on both sides."""
    place = lambda x, y: F.struct(F.least(x, y).alias("row_i"), F.greatest(x, y).alias("row_j"), (x < y).alias("ahead"))
    return F.array_sort(F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: place(x, y)))))


def _take_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that are matched in their pair of rows, of links in order; a contig is in one of the two rows only."""
    at, used = None, set()
    for batch in batches:
        taken = []
        for i, j, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("row_i", "row_j", "lo", "hi")), strict=True):
            if at != (i, j):
                at, used = (i, j), set()
            taken.append(lo not in used and hi not in used)
            if taken[-1]:
                used |= {lo, hi}
        yield batch.filter(pa.array(taken, pa.bool_()))


def _wave(open_: DataFrame, ready: DataFrame) -> DataFrame:
    """``open_`` without the links dropped in the pairs of rows ``ready``, those matched there one place further."""
    place = F.try_element_at(_places(), F.col("at") + 1)
    rows = open_.withColumn("place", place).withColumns({c: F.col(f"place.{c}") for c in ("row_i", "row_j")}).drop("place")
    now, key = rows.join(ready, ["row_i", "row_j"], "left_semi").select(rows.columns), ["row_i", "row_j"]
    taken = now.repartition(*key).sortWithinPartitions(*key, F.desc("pairs"), "lo", "hi").mapInArrow(_take_first, now.schema)
    later = rows.join(ready, key, "left_anti")
    return taken.withColumn("at", F.col("at") + 1).select(open_.columns).unionByName(later.select(open_.columns))


def _rounds(found: DataFrame, rest: int) -> DataFrame:
    """(lo, hi) of the links dropped, from links at their places, in rounds over all of them at once."""
    open_, gone = found, None
    while open_.count() > rest:
        done = stored(_settled(open_), "settled")
        new = done.filter("dropped").select("lo", "hi")
        gone = new if gone is None else gone.unionByName(new)
        open_ = stored(done.filter("NOT matched AND NOT out").withColumn("blocked", F.col("blocked") | F.col("hit")).select(open_.columns), "open")
    last = open_.drop("at").repartition(1).mapInPandas(_greedy, "lo int, hi int")
    return (last if gone is None else gone.unionByName(last)).distinct()


def match_rows(counts: DataFrame, rows: DataFrame, rest: int = REST, most: int = MOST) -> DataFrame:
    """Link counts after pruning within rows and greedy matching between rows.

    Two rows at a time, in their order, take their strongest links between contigs that are still free and
    drop the others; what is dropped isn't seen by later pairs of rows. A link is one row with the rows of its
    contigs, and stands at one of its places (pairs of rows) at a time. In waves, all pairs of rows where every
    link that has a place there has come to it are gone through, each as a stream of sorted links; few links
    outlast their first place, and only these go on. Pairs of rows with more than ``most`` links are left
    alone. When a wave would settle few links, the rest is done in rounds over all links at all their places:
    a link is matched where it is the first left of both its contigs and of its own places in the order. That
    blocks the other links of these contigs in this pair of rows; a blocked link is dropped, with all its later
    places, once its earlier places are settled. The first link left is always settled, so the rounds end; when
    at most ``rest`` are left one task goes through them.
    """
    of, none = rows_of(rows), F.array().cast(rows.select(F.array("row_id").alias("x")).schema["x"].dataType)
    sides = [of.select(F.col("contig_id").alias(end), F.col("rows").alias(side)) for end, side in (("lo", "a"), ("hi", "b"))]
    placed = counts.join(sides[0], "lo", "left").join(sides[1], "hi", "left").withColumns({c: F.coalesce(c, none) for c in "ab"})
    now = stored(placed.filter(~F.arrays_overlap("a", "b")).select("lo", "hi", "pairs", "a", "b", F.lit(0).alias("at")), "placed")
    done, result = F.col("at") == F.size("a") * F.size("b"), ["lo", "hi", "pairs"]
    kept, open_ = now.filter(done).select(result), now.filter(~done)
    while (left := open_.count()) > rest:
        each = open_.select("at", F.posexplode(_places()).alias("k", "place")).filter("k >= at").groupBy("place.row_i", "place.row_j")
        each = each.agg(F.count_if(F.col("k") == F.col("at")).alias("n"), F.max(F.col("k") > F.col("at")).alias("early"))
        ready = stored(each.filter(~F.col("early") & (F.col("n") <= most)), "ready")
        if (ready.agg(F.sum("n")).first()[0] or 0) * SHARE < left:
            break
        now = stored(_wave(open_, ready), "wave")
        kept, open_ = kept.unionByName(now.filter(done).select(result)), now.filter(~done)
    found = open_.select(*result, "at", F.posexplode(_places()).alias("k", "place")).filter("k >= at")
    found = found.select(
        "place.row_i", "place.row_j", F.when(F.col("place.ahead"), F.col("lo")).otherwise(F.col("hi")).alias("contig_i"), F.when(F.col("place.ahead"), F.col("hi")).otherwise(F.col("lo")).alias("contig_j"),
        "pairs", "lo", "hi", F.struct("place.row_i", "place.row_j", (-F.col("pairs")).alias("less"), "lo", "hi").alias("at"), F.lit(False).alias("blocked"))
    return kept.unionByName(open_.select(result).join(_rounds(stored(found, "open"), rest), ["lo", "hi"], "left_anti"))


__all__ = ["conflict_texts", "conflicts", "match_rows", "members", "prune_within_rows", "row_candidates", "rows_of"]
