"""Sequential operators against naive restatements, and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactweave.functions import storage
from contactweave.jobs import catalog
from contactweave.operators import allele, cluster, components, order, running
from contactweave.sources import bindings


def naive_partition(weights, nodes, k, veto):
    clusters, n = [[c] for c in nodes], len(nodes)
    score = lambda g, m: sum(weights.get((i, j), 0.0) for i in g for j in m) / len(g) / len(m)
    ops = [(w, a, b) for (a, b), w in weights.items() if a < b]
    ops = [(w, [a], [b]) for w, a, b in ops]
    accepted = plain = 0
    while ops and len(clusters) > k:
        best = min(range(len(ops)), key=lambda o: (-ops[o][0], *sorted((min(ops[o][1]), min(ops[o][2])))))
        _, a, b = ops.pop(best)
        if any((x, y) in veto for x in a for y in b):
            continue
        plain += (len(a) == 1) + (len(b) == 1) - 1
        ops = [o for o in ops if o[1] not in (a, b) and o[2] not in (a, b)]
        merged = sorted(a + b)
        clusters = [c for c in clusters if c not in (a, b)] + [merged]
        for g in clusters[:-1]:
            if (s := score(g, merged)) > 0:
                ops.append((s, g, merged))
        accepted += 1
        if accepted > n // 2 and plain == k:
            break
    return [sorted(c) for c in clusters if len(c) > 1]


@pytest.mark.parametrize("seed", range(12))
def test_partition(spark, seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(4, 14)), int(rng.integers(1, 4))
    weights = {}
    for a in range(n):
        for b in range(a + 1, n):
            if rng.random() < 0.4:
                weights[a, b], weights[b, a] = (float(x) + 0.001 * (a * n + b) for x in rng.integers(1, 60, 2))
    if not weights:
        return
    veto = {(a, b) for a in range(n) for b in range(n) if a < b and rng.random() < 0.08}
    veto |= {(b, a) for a, b in veto}
    edges = spark.createDataFrame([(a, b, 5, w) for (a, b), w in weights.items()], "start int, end int, pairs long, weight double")
    contigs = spark.createDataFrame([(c,) for c in range(n)], "contig_id int")
    bars = spark.createDataFrame([((1 << 40) + k, list(p)) for k, p in enumerate(sorted(veto))], "row_id long, contig_ids array<int>") if veto else None
    got = cluster.partition(edges, contigs.limit(0), contigs, k, bars).orderBy("group_id", "contig_id").collect()
    groups = {}
    for r in got:
        groups.setdefault(r.group_id, []).append(r.contig_id)
    assert [groups[g] for g in sorted(groups)] == naive_partition(weights, range(n), k, veto)


def naive_match(pairs, table):
    pairs = {p: n for p, n in pairs.items() if not any(p[0] in r and p[1] in r for r in table)}
    for i in range(len(table)):
        for j in range(i + 1, len(table)):
            a, b = set(table[i]) - set(table[j]), set(table[j]) - set(table[i])
            found = [(-n, lo, hi, x, y) for (lo, hi), n in pairs.items() for x, y in ((lo, hi), (hi, lo)) if x in a and y in b]
            for _, lo, hi, x, y in sorted(found):
                if x in a and y in b:
                    a.discard(x)
                    b.discard(y)
                else:
                    pairs.pop((lo, hi), None)
    return sorted(pairs)


@pytest.mark.parametrize(("seed", "rest"), [(0, 0), (1, 0), (2, 0), (3, 5), (4, 50_000), (5, 50_000)])
def test_match_rows(spark, seed, rest):
    rng = np.random.default_rng(seed)
    pairs = {(a, b): int(rng.integers(1, 1000)) for a in range(12) for b in range(a + 1, 12) if rng.random() < 0.5}
    table = [sorted(rng.choice(12, int(rng.integers(2, 5)), replace=False).tolist()) for _ in range(5)]
    counts = spark.createDataFrame([(*p, n) for p, n in pairs.items()], "lo int, hi int, pairs long")
    rows = spark.createDataFrame(list(enumerate(table)), "row_id int, contig_ids array<int>")
    assert sorted((r.lo, r.hi) for r in allele.match_rows(counts, rows, rest).collect()) == naive_match(pairs, table)


@pytest.mark.parametrize(("seed", "most"), [(6, 0), (7, 3), (8, 10**6)])
def test_match_rows_waves(spark, seed, most):
    """By rounds alone, by waves over small pairs of rows and then rounds, and by waves alone, with ties of strength."""
    rng = np.random.default_rng(seed)
    pairs = {(a, b): int(rng.integers(1, 4)) for a in range(14) for b in range(a + 1, 14) if rng.random() < 0.6}
    table = [sorted(rng.choice(12, int(rng.integers(2, 5)), replace=False).tolist()) for _ in range(6)]
    counts = spark.createDataFrame([(*p, n) for p, n in pairs.items()], "lo int, hi int, pairs long")
    rows = spark.createDataFrame(list(enumerate(table)), "row_id int, contig_ids array<int>")
    assert sorted((r.lo, r.hi) for r in allele.match_rows(counts, rows, 0, most).collect()) == naive_match(pairs, table)


def test_matching_stores_no_link_at_all_its_places(spark, monkeypatch):
    """What is stored on the way has a row a link, not one for each of its pairs of rows."""
    sizes = {}

    def kept(df, name):
        out = storage.stored(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(allele, "stored", kept)
    counts, rows = catalog.QUERIES["link_counts"](spark, SF), bindings.allele_rows(spark, SF)
    links = counts.count()
    allele.match_rows(counts, rows, 100).collect()
    assert max(sizes.values()) <= links


def _table(spark, seed, most):
    """Allele rows of 40 contigs in up to ``most`` rows each, one contig alone in its row, and one row listed in two parts."""
    rng = np.random.default_rng(seed)
    table = [(k, sorted(rng.choice(40, int(rng.integers(2, most)), replace=False).tolist())) for k in range(12)] + [(50, [70]), (3, [1, 2, None]), (None, [5, 6])]
    pairs = {(a, b) for k in range(12) for own in [{c for j, t in table for c in t if j == k and c is not None}] for a in own for b in own if a != b}
    return spark.createDataFrame(table, "row_id int, contig_ids array<int>"), pairs


@pytest.mark.parametrize("seed", [0, 1])
def test_conflicts(spark, seed):
    rows, pairs = _table(spark, seed, 9)
    got = {r.contig_id: r.other_ids for r in allele.conflicts(rows).collect()}
    assert got == {a: sorted(y for x, y in pairs if x == a) for a, _ in pairs}
    assert {r.contig_id: r.other_ids for r in allele.conflict_texts(rows).collect()} == {c: ",".join(map(str, x)) for c, x in got.items()}


@pytest.mark.parametrize(("seed", "most"), [(0, 6), (1, 9), (2, 39)])
def test_cluster_conflicts(spark, seed, most):
    """Also contigs in more rows than are counted by their sets, and contigs listed twice or in two groups."""
    rows, pairs = _table(spark, seed, most)
    members = [(c % 3, c) for c in range(40)] + [(1, 4), (1, 4), (0, 7), (None, 8)]
    want = {}
    for a, x in members:
        for b, y in members:
            if a is not None and b is not None and a < b and (x, y) in pairs:
                want[a, b] = want.get((a, b), 0) + 1
    got = cluster.cluster_conflicts(rows, spark.createDataFrame(members, "group_id int, contig_id int")).collect()
    assert {(r.group_a, r.group_b): r.conflicts for r in got} == want


def test_conflicts_pair_no_contigs(spark):
    """4,000 contigs of one row are 16 million pairs."""
    rows = spark.range(1).select(F.lit(1).alias("row_id"), F.sequence(F.lit(0), F.lit(3999)).alias("contig_ids"))
    members = spark.range(4000).select((F.col("id") % 2).cast("int").alias("group_id"), F.col("id").cast("int").alias("contig_id"))
    assert [tuple(r) for r in cluster.cluster_conflicts(rows, members).collect()] == [(0, 1, 4_000_000)]
    assert allele.conflict_texts(rows).filter("contig_id = 2").first().other_ids.startswith("0,1,3,4,")


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 80)], [(5, 4), (4, 3), (9, 8), (3, 5)]])
def test_components(spark, edges):
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root


def test_ordering(spark):
    rng = np.random.default_rng(1)
    n = 12
    contigs = spark.createDataFrame([(k, 1000 + 10 * k) for k in range(2 * n)], "contig_id int, length int")
    members = spark.createDataFrame([(k % 2, k) for k in range(2 * n)], "group_id int, contig_id int")
    edges = [(a, b, int(1000 / (abs(a - b) ** 2)) + int(rng.integers(1, 3)), 1.0) for a in range(2 * n) for b in range(2 * n) if a != b]
    links = order.group_edges(spark.createDataFrame(edges, "start int, end int, pairs long, weight double"), members)
    run = lambda: order.order_groups(links, members, contigs, ngen=40, max_gen=200, npop=30).orderBy("group_id", "ord").collect()
    got = run()
    assert got == run()
    for g in (0, 1):
        own = [r for r in got if r.group_id == g]
        assert sorted(r.contig_id for r in own) == list(range(g, 2 * n, 2)) and [r.ord for r in own] == list(range(n))
        assert own[0].score <= own[0].start_score
    mids = order.midpoints(spark.createDataFrame([(r.group_id, r.ord, r.contig_id) for r in got], "group_id int, ord int, contig_id int"), contigs)
    scores = {r.group_id: r.score for r in order.order_scores(links, mids).collect()}
    assert all(abs(scores[r.group_id] - r.score) < 1e-9 for r in got)


SF = "/root/testdata/sf0.01"


def test_partition_query(spark):
    """The registered query on its whole tables, with vetoes, against the naive loop."""
    g = catalog._graph(spark, SF)
    bad = {r.contig_id for r in g.invalid.collect()}
    nodes = sorted(r.contig_id for r in g.contigs.collect() if r.contig_id not in bad)
    weights = {(r.start, r.end): r.weight for r in g.edges.collect() if r.start not in bad and r.end not in bad}
    veto = {(r.contig_id, c) for r in allele.conflicts(bindings.allele_rows(spark, SF)).collect() for c in r.other_ids}
    groups = {}
    for r in catalog.QUERIES["partition_groups"](spark, SF).collect():
        groups.setdefault(r.group_id, []).append(r.contig_id)
    assert len(nodes) > 50 and [sorted(groups[k]) for k in sorted(groups)] == naive_partition(weights, nodes, catalog.GROUPS, veto)


def test_matching_query(spark):
    """The registered query on its whole tables against the naive loop."""
    pairs = {(r.lo, r.hi): r.pairs for r in catalog.QUERIES["link_counts"](spark, SF).collect()}
    table = [r.contig_ids for r in bindings.allele_rows(spark, SF).orderBy("row_id").collect()]
    got = catalog.QUERIES["allele_greedy_match"](spark, SF).collect()
    assert sorted((r.lo, r.hi) for r in got) == naive_match(pairs, table) and all(pairs[r.lo, r.hi] == r.pairs for r in got)


def test_matching_rounds_spread(spark):
    """One chain of rows that all have links with each other, settled in rounds: as the naive loop, by several tasks."""
    rng = np.random.default_rng(8)
    table = [list(range(20 * k, 20 * k + 21)) for k in range(6)]
    pairs = {(a, b): int(rng.integers(1, 50)) for a in range(121) for b in range(a + 1, 121) if rng.random() < 0.4}
    counts = spark.createDataFrame([(*p, n) for p, n in pairs.items()], "lo int, hi int, pairs long")
    rows = spark.createDataFrame(list(enumerate(table)), "row_id int, contig_ids array<int>")
    assert sorted((r.lo, r.hi) for r in allele.match_rows(counts, rows, 1000).collect()) == naive_match(pairs, table)


def test_ordering_query(spark, sf):
    """The registered query orders every contig once, and its score is that of the order."""
    links = {(r.group_id, r.lo, r.hi): r.pairs for r in catalog.QUERIES["group_edges"](spark, sf).collect()}
    length = {r.contig_id: r.length for r in bindings.contigs(spark, sf).collect()}
    group = {r.contig_id: r.group_id for r in bindings.groups(spark, sf).collect()}
    got = sorted(catalog.QUERIES["ordering"](spark, sf).collect(), key=lambda r: (r.group_id, r.ord))
    assert sorted(r.contig_id for r in got) == sorted(length)
    for k in set(group.values()):
        own = [r for r in got if r.group_id == k]
        assert [r.ord for r in own] == list(range(len(own))) and all(group[r.contig_id] == k for r in own)
        at, mid = 0, {}
        for r in own:
            mid[r.contig_id], at = at + length[r.contig_id] / 2, at + length[r.contig_id]
        score = lambda m: -sum(n / abs(m[a] - m[b]) for (g, a, b), n in links.items() if g == k and abs(m[a] - m[b]) <= order.LIMIT)
        assert abs(score(mid) - own[0].score) < 1e-9 and own[0].score <= own[0].start_score


@pytest.mark.parametrize("n", [0, 1, 400])
def test_ranked(spark, n):
    rng = np.random.default_rng(n)
    data = [(float(x), k, int(v)) for k, (x, v) in enumerate(zip(rng.integers(0, 9, n), rng.integers(-3, 4, n), strict=True))]
    df = spark.createDataFrame(data, "x double, k int, v int").repartition(5)
    want, total = [], 0
    for at, (x, k, v) in enumerate(sorted(data, key=lambda r: (-r[0], r[1]))):
        total += v
        want.append((x, k, v, at + 1, total))
    assert sorted(map(tuple, running.ranked(df, [F.desc("x"), F.col("k")], "v").select("x", "k", "v", "n", "running").collect()), key=lambda r: r[3]) == want


@pytest.mark.parametrize(("n", "k"), [(5, 3), (3, 3), (2, 2), (1, 1)])
def test_distinct_draws(n, k):
    seen = order._distinct(np.random.default_rng(n), n, k, 3000)
    every, times = np.unique(seen, axis=0, return_counts=True)
    assert all(len(set(r)) == k for r in seen.tolist()) and seen.min() >= 0 and seen.max() < n
    assert len(every) == math.comb(n, k) and times.min() > 0.7 * 3000 / len(every)


@pytest.mark.parametrize("kind", [0.1, 0.3, 0.5, 0.9])
def test_mutations(kind):
    start = np.arange(6)
    want = {0.1: [[0, 4, 2, 3, 1, 5]], 0.3: [[4, 5, 0, 1, 2, 3]], 0.5: [[0, 2, 3, 4, 1, 5], [0, 4, 1, 2, 3, 5]], 0.9: [[0, 4, 3, 2, 1, 5]]}[kind]
    assert [order._mutate(start.copy(), kind, 1, 4, back).tolist() for back in (False, True)][: len(want)] == want


@pytest.mark.parametrize(("limit", "square"), [(order.LIMIT, order.SQUARE), (400, order.SQUARE), (400, 0), (400, 60), (0, order.SQUARE)])
def test_scores_made_from_changes(monkeypatch, limit, square):
    """A mutated order's score, made from the pairs across its cuts, is that of all pairs to the last digit."""
    monkeypatch.setattr(order, "LIMIT", limit)
    monkeypatch.setattr(order, "SQUARE", square)
    rng, n, rows = np.random.default_rng(limit + square), 60, 2000
    i, j = np.triu_indices(n, 1)
    some = rng.random(len(i)) < 0.8
    length, i, j, links = rng.integers(50, 200, n).astype(float), i[some], j[some], rng.integers(1, 30, some.sum()).astype(float)
    score = order.Scoring(length, i, j, links)
    assert score.by_cuts == (limit < length.sum()) and (score.square is None) == (square < n)
    before = np.array([rng.permutation(n) for _ in range(rows)])
    after, cuts = before.copy(), []
    for row, kind, (p, q), back in zip(after, rng.random(rows), order._distinct(rng, n, 2, rows).tolist(), rng.random(rows) < 0.5, strict=True):
        order._mutate(row, kind, p, q, back)
        cuts.append(order._cuts(n, kind, p, q, back))
    full = score(after)
    assert np.array_equal(score(before) + score.change(before, after, *np.array(cuts).swapaxes(0, 1)), full)
    assert np.allclose(full / score.scale, order._fitness(after, length, i, j, links), rtol=1e-12, atol=0)


def test_a_change_scores_few_pairs():
    """Links of far contigs cost nothing: a change looks at squares of ``reach`` around its cuts."""
    n, rng = 250, np.random.default_rng(3)
    i, j = np.triu_indices(n, 1)
    score, seen = order.Scoring(np.full(n, 600_000.0), i, j, np.ones(len(i))), []
    between = score._between
    score._between = lambda x, y: seen.append(np.broadcast(x, y).size) or between(x, y)
    before = np.array([rng.permutation(n)])
    after = np.array([order._mutate(before[0].copy(), 0.9, 60, 190, False)])
    score.change(before, after, *(np.array([c]) for c in order._cuts(n, 0.9, 60, 190, False)))
    assert score.reach == 17 and sum(seen) == 2 * 2 * score.reach**2 < len(i) // 20


def one_at_a_time(start, score, rng, mutapb, ngen, max_gen, npop, shuffle):
    """The search with all orders laid out, and each change scored on all links."""
    population = np.array([rng.permutation(start) for _ in range(npop)]) if shuffle else np.tile(start, (npop, 1))
    scores = score(population)
    best, least, since = population[np.argmin(scores)].copy(), scores.min(), 0
    for _ in range(max_gen):
        contest = order._distinct(rng, npop, min(3, npop), npop)
        population = population[contest[np.arange(npop), np.argmin(scores[contest], axis=1)]]
        changed = np.flatnonzero(rng.random(npop) < mutapb)
        if len(start) > 1 and len(changed):
            places, kinds, backs = order._distinct(rng, len(start), 2, len(changed)), rng.random(len(changed)), rng.random(len(changed)) < 0.5
            for at, (p, q), kind, back in zip(changed, places, kinds, backs, strict=True):
                order._mutate(population[at], kind, p, q, back)
        scores, since = score(population), since + 1
        if scores.min() < least:
            best, least, since = population[np.argmin(scores)].copy(), scores.min(), 0
        if since > ngen:
            break
    return best, least


def _linked(seed, n, share, most=30):
    rng = np.random.default_rng(seed)
    i, j = np.triu_indices(n, 1)
    some = rng.random(len(i)) < share
    return order.Scoring(rng.integers(50, 200, n).astype(float), i[some], j[some], rng.integers(1, most, some.sum()).astype(float))


@pytest.mark.parametrize(
    ("n", "limit", "square", "share", "npop", "shuffle", "by_cuts"),
    [(1, 400, 4096, 1, 5, False, False), (2, 400, 4096, 1, 1, True, False), (9, 10**7, 4096, 0.7, 30, False, False), (60, 400, 4096, 0.8, 40, False, True), (60, 400, 0, 0.3, 40, True, True), (60, 0, 0, 0.8, 3, False, True), (60, 400, 4096, 0, 20, False, False)],
)
def test_search_ahead_is_that_of_one_generation_at_a_time(monkeypatch, n, limit, square, share, npop, shuffle, by_cuts):
    """Orders, scores and the draws that follow are the same, whether or not the search ends inside a block of draws."""
    monkeypatch.setattr(order, "LIMIT", limit)
    monkeypatch.setattr(order, "SQUARE", square)
    score = _linked(n + npop, n, share)
    assert score.by_cuts == by_cuts
    for ngen, max_gen in ((30, 1000), (500, 150), (3, 0)):
        a, b = np.random.default_rng(ngen), np.random.default_rng(ngen)
        got, want = order.evolve(np.arange(n), score, a, 0.3, ngen, max_gen, npop, shuffle), one_at_a_time(np.arange(n), score, b, 0.3, ngen, max_gen, npop, shuffle)
        assert got[0].tolist() == want[0].tolist() and got[1] == want[1] and a.random() == b.random()


def test_changes_are_scored_ahead(monkeypatch):
    """While nothing is gained, few generations score changes of their own, and the population's orders are not copied."""
    monkeypatch.setattr(order, "LIMIT", 400)
    score, asked, laid = _linked(5, 60, 0.8), [], []
    rng = np.random.default_rng(1)
    best, _ = order.evolve(np.arange(60), score, rng, 0.2, 2000, 20_000, 100)
    changes, mutate = score.changes, order._mutate
    score.changes = lambda *a, **k: asked.append(len(a[3])) or changes(*a, **k)
    monkeypatch.setattr(order, "_mutate", lambda *a: laid.append(1) or mutate(*a))
    order.evolve(best, score, rng, 0.2, 400, 640, 100)
    assert len(asked) < 640 / 3 and sum(x >= 200 for x in asked) >= 5 and len(laid) < 10 * 100


def test_ordering_without_links_or_lengths(spark):
    """A group of one contig, one without links, and one whose contigs are empty."""
    members = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (3, 4), (3, 5)], "group_id int, contig_id int")
    contigs = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 0), (5, 0)], "contig_id int, length int")
    links = spark.createDataFrame([(3, 4, 5, 2)], "group_id int, lo int, hi int, pairs long")
    got = order.order_groups(links, members, contigs, ngen=5, max_gen=20, npop=4).collect()
    assert sorted((r.group_id, r.contig_id) for r in got) == [(1, 1), (2, 2), (2, 3), (3, 4), (3, 5)]


def test_groups_are_ordered_by_tasks_of_their_own(spark):
    """Groups of few rows aren't put into one task."""
    members = spark.createDataFrame([(k % 4, k) for k in range(12)], "group_id int, contig_id int")
    contigs = spark.createDataFrame([(k, 10 + k) for k in range(12)], "contig_id int, length int")
    links = spark.createDataFrame([(k % 4, k, k + 4, 2) for k in range(8)], "group_id int, lo int, hi int, pairs long")
    got = order.order_groups(links, members, contigs, ngen=5, max_gen=20, npop=4).withColumn("task", F.spark_partition_id())
    assert len({r.task for r in got.collect()}) == 4
