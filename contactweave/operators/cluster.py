"""Grouping contigs into chromosomes by constrained average linkage.

Merges never cross connected components of the contact graph, and what a component
does next depends on its own history alone. So every component's merges are computed
in parallel up to its last one, as a list with scores; the lists are then put in the
order one global loop would have taken them (by the lowest score so far, descending:
a merge scored above its predecessor follows it at once), the two stop rules become
running counts over that order, and each component replays as many merges as fell
before the stop.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactweave.operators.allele import members, rows_of
from contactweave.operators.components import components
from contactweave.operators.running import ranked

MERGES = "root int, step int, a int, b int, low double, singles int"


def merge_ops(edges: DataFrame, invalid: DataFrame) -> DataFrame:
    """(a, b, score): first merge candidates, the edges low to high between two valid contigs."""
    rows = edges.filter("start < end").select(F.col("start").alias("a"), F.col("end").alias("b"), F.col("weight").alias("score"))
    for end in ("a", "b"):
        rows = rows.join(invalid.select(F.col("contig_id").alias(end)), end, "left_anti")
    return rows.select("a", "b", "score")


def component_merges(edges: list[tuple[int, int, float]], rows_of: dict[int, set[int]]) -> list[tuple[int, int, float, int]]:
    """All merges of one component: (kept cluster, taken cluster, lowest score so far, singletons used up).

    ``rows_of``: a contig's allele rows; clusters that have contigs of one row must not merge.

    A cluster is named by its smallest contig. Sums of the weights from one cluster to another
    add up when clusters merge, so a candidate's score is a sum over sizes and never a new scan.
    """
    links: dict[int, dict[int, float]] = defaultdict(dict)
    into: dict[int, set[int]] = defaultdict(set)
    names: set[int] = set()
    heap = []
    for a, b, w in edges:
        links[a][b] = w
        into[b].add(a)
        names |= {a, b}
        if a < b:
            heap.append((-w, a, b, 0, 0))
    heapq.heapify(heap)
    size, version = dict.fromkeys(names, 1), dict.fromkeys(names, 0)
    barred = {n: set(rows_of.get(n, ())) for n in names}
    out, low = [], float("inf")
    while heap:
        score, a, b, va, vb = heapq.heappop(heap)
        if version.get(a) != va or version.get(b) != vb:
            continue
        low = min(low, -score)
        if not barred[a].isdisjoint(barred[b]):
            continue
        keep, gone = min(a, b), max(a, b)
        out.append((keep, gone, low, (size[a] == 1) + (size[b] == 1)))
        barred[keep] |= barred.pop(gone)
        size[keep] += size.pop(gone)
        version.pop(gone)
        version[keep] += 1
        for to, w in links.pop(gone, {}).items():
            into[to].discard(gone)
            if to != keep:
                links[keep][to] = links[keep].get(to, 0.0) + w
                into[to].add(keep)
        for other in into.pop(gone, ()):
            w = links[other].pop(gone)
            if other != keep:
                links[other][keep] = links[other].get(keep, 0.0) + w
                into[keep].add(other)
        for other in into[keep]:
            if (total := links[other][keep]) > 0:
                x, y = sorted((other, keep))
                heapq.heappush(heap, (-(total / size[other] / size[keep]), x, y, version[x], version[y]))
    return out


def partition(edges: DataFrame, invalid: DataFrame, contigs: DataFrame, groups: int, allele_rows: DataFrame | None = None) -> DataFrame:
    """(group_id, contig_id): clusters of two and more contigs, numbered from 1 by their last merge.

    Allele rows (row_id, contig_ids) bar merges by their members, a row a contig and allele row; their contigs are never paired.
    """
    ends = [F.col(c).alias("contig_id") for c in ("start", "end")]
    valid = edges
    for end in ends:
        valid = valid.join(invalid.select(F.col("contig_id").alias("_cw_no")), end == F.col("_cw_no"), "left_anti")
    roots = components(valid.select(F.col("start").alias("a"), F.col("end").alias("b")))
    rows = valid.join(roots.select(F.col("node").alias("start"), "root"), "start").select("root", F.col("start").alias("x"), F.col("end").alias("y"), "weight")
    if allele_rows is not None:
        barred = members(allele_rows).select(F.col("contig_id").alias("x"), F.col("row_id").cast("long").alias("y"))
        barred = barred.join(roots.select(F.col("node").alias("x"), "root"), "x").select("root", "x", "y", F.lit(None).cast("double").alias("weight"))
        rows = rows.unionByName(barred)

    def merges(group: pd.DataFrame) -> pd.DataFrame:
        links, bars = group[group.weight.notna()], group[group.weight.isna()]
        rows_of: dict[int, set[int]] = defaultdict(set)
        for x, y in zip(bars.x.tolist(), bars.y.tolist(), strict=True):
            rows_of[x].add(y)
        found = component_merges(list(zip(links.x.tolist(), links.y.tolist(), links.weight.tolist(), strict=True)), rows_of)
        out = pd.DataFrame(found, columns=["a", "b", "low", "singles"]).reset_index(names="step")
        return out.assign(root=group.root.iloc[0])[["root", "step", "a", "b", "low", "singles"]]

    merged = rows.groupBy("root").applyInPandas(merges, MERGES)
    # One row a merge, fewer than contigs.
    done = ranked(merged.withColumn("fewer", F.col("singles") - 1), [F.desc("low"), F.col("root"), F.col("step")], "fewer", "n", "plain")
    start = contigs.join(invalid, "contig_id", "left_anti").agg(F.count("*")).scalar()
    last = done.withColumn("n0", start).filter((F.col("n") > F.expr("n0 div 2")) & (F.col("plain") == groups)).agg(F.min("n")).scalar()
    taken = done.withColumn("n0", start).withColumn("last", last).filter((F.col("n") <= F.col("n0") - groups) & (F.col("last").isNull() | (F.col("n") <= F.col("last"))))

    def replay(group: pd.DataFrame) -> pd.DataFrame:
        inside: dict[int, list[int]] = {}
        at: dict[int, int] = {}
        for a, b, n in group.sort_values("step")[["a", "b", "n"]].itertuples(index=False):
            inside[a] = inside.pop(a, [a]) + inside.pop(b, [b])
            at.pop(b, None)
            at[a] = n
        return pd.DataFrame([(at[a], c) for a, contigs in inside.items() for c in contigs], columns=["last", "contig_id"])

    clusters = taken.select("root", "step", "a", "b", "n").groupBy("root").applyInPandas(replay, "last int, contig_id int")
    number = clusters.select("last").distinct().withColumn("group_id", F.row_number().over(Window.orderBy("last")))
    return clusters.join(number, "last").select("group_id", "contig_id")


def cluster_linkage(edges: DataFrame, members: DataFrame) -> DataFrame:
    """(from_group, to_group, total, linkage) between different groups that links connect."""
    sizes = members.groupBy("group_id").agg(F.count("*").alias("n"))
    rows = edges.join(members.select(F.col("contig_id").alias("start"), F.col("group_id").alias("from_group")), "start")
    rows = rows.join(members.select(F.col("contig_id").alias("end"), F.col("group_id").alias("to_group")), "end").filter("from_group <> to_group")
    sums = rows.groupBy("from_group", "to_group").agg(F.sum("weight").alias("total"))
    sums = sums.join(sizes.select(F.col("group_id").alias("from_group"), F.col("n").alias("n1")), "from_group").join(sizes.select(F.col("group_id").alias("to_group"), F.col("n").alias("n2")), "to_group")
    return sums.select("from_group", "to_group", "total", (F.col("total") / F.col("n1") / F.col("n2")).alias("linkage"))


#: Rows of a contig up to which sets of them are counted, at most 255 a contig.
FEW_ROWS = 8


def _subsets(rows: str) -> Column:
    """The non-empty subsets of an array of a few rows, each sorted as the array is."""
    chosen = lambda mask: F.filter(rows, lambda _, k: mask.bitwiseAND(F.element_at(bits, k + 1)) != 0)
    bits = F.array(*[F.lit(1 << k) for k in range(FEW_ROWS)])
    last = F.element_at(bits, F.size(rows)) * 2 - 1
    return F.transform(F.sequence(F.lit(1), last), chosen)


def cluster_conflicts(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(group_a, group_b, conflicts), group_a < group_b: groups that must not merge, and how many pairs of contigs that share an allele row say so.

    Contigs are counted, never paired: by the sets of rows they have and their group. Pairs that share some row
    are, by inclusion and exclusion, those that share each set of rows, added for odd sets and taken off for even
    ones. Contigs with more than ``FEW_ROWS`` rows have too many such sets; their kinds (rows, group) meet the
    others over their rows, each two once.
    """
    placed = rows_of(rows).join(members.filter("group_id IS NOT NULL").select("contig_id", "group_id"), "contig_id")
    kinds = placed.groupBy("rows", "group_id").agg(F.count("*").alias("n"))
    few = F.size("rows") <= FEW_ROWS
    sums = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("n"))
    shared = sums(kinds.filter(few).select(F.explode(_subsets("rows")).alias("set"), "group_id", "n"), "set", "group_id")
    side = lambda df, k, *keys: df.select(*keys, F.col("group_id").alias(f"group_{k}"), F.col("n").alias(f"n_{k}"))
    both = side(shared, "a", "set").join(side(shared, "b", "set"), "set").filter("group_a < group_b")
    sign = F.when(F.size("set") % 2 == 1, 1).otherwise(-1)
    parts = both.select("group_a", "group_b", (sign * F.col("n_a") * F.col("n_b")).alias("n"))
    # Kinds of many rows, with all kinds.
    each = kinds.select("rows", "group_id", "n", F.explode("rows").alias("row_id"))
    met = side(each.filter(~few), "x", "row_id", F.col("rows").alias("rows_x")).join(side(each, "y", "row_id", F.col("rows").alias("rows_y")), "row_id").filter("group_x <> group_y")
    # Of two kinds of many rows each is met from both.
    met = met.filter((F.size("rows_y") <= FEW_ROWS) | (F.col("group_x") < F.col("group_y"))).drop("row_id").distinct()
    many = met.select(F.least("group_x", "group_y").alias("group_a"), F.greatest("group_x", "group_y").alias("group_b"), (F.col("n_x") * F.col("n_y")).alias("n"))
    # A contig that is listed in two groups doesn't conflict with itself.
    own = placed.groupBy("contig_id", "group_id").agg(F.count("*").alias("n")).withColumn("groups", F.count("*").over(Window.partitionBy("contig_id"))).filter("groups > 1")
    twice = side(own, "a", "contig_id").join(side(own, "b", "contig_id"), "contig_id").filter("group_a < group_b").select("group_a", "group_b", (-F.col("n_a") * F.col("n_b")).alias("n"))
    total = sums(parts.unionByName(many).unionByName(twice), "group_a", "group_b")
    return total.filter("n > 0").withColumnRenamed("n", "conflicts")


def recover(edges: DataFrame, members: DataFrame, skipped: DataFrame, ratio: float = 3.0) -> DataFrame:
    """(contig_id, group_id, best, second): skipped contigs that one group attracts clearly more than any other.

    The mean linkage to a group counts all its contigs; all are judged against the same groups.
    """
    sizes = members.groupBy("group_id").agg(F.count("*").alias("n"))
    rows = edges.join(skipped.select(F.col("contig_id").alias("start")), "start").join(members.select(F.col("contig_id").alias("end"), "group_id"), "end")
    mean = rows.groupBy(F.col("start").alias("contig_id"), "group_id").agg(F.sum("weight").alias("total")).join(sizes, "group_id")
    mean = mean.select("contig_id", "group_id", (F.col("total") / F.col("n")).alias("best"))
    order = Window.partitionBy("contig_id").orderBy(F.desc("best"), "group_id")
    mean = mean.withColumn("k", F.row_number().over(order)).withColumn("second", F.coalesce(F.lead("best").over(order), F.lit(0.0)))
    clear = (F.col("best") >= ratio) & ((F.col("second") == 0) | (F.try_divide(F.col("best"), F.col("second")) >= ratio))
    return mean.filter((F.col("k") == 1) & clear).select("contig_id", "group_id", "best", "second")


def group_stats(members: DataFrame, contigs: DataFrame) -> DataFrame:
    """(group_id, contigs, total_re, total_bp, bp_per_re)."""
    sums = members.join(contigs, "contig_id").groupBy("group_id").agg(
        F.count("*").alias("contigs"), F.sum(F.col("re_count").cast("long")).alias("total_re"), F.sum(F.col("length").cast("long")).alias("total_bp"))
    return sums.withColumn("bp_per_re", F.expr("total_bp div total_re"))
