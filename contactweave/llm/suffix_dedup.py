"""Removal of long repeated byte strings by a distributed merge sort of suffixes.

Which suffixes: a byte is removed if a string of ``MATCH`` bytes over it starts anywhere
else too. Every such window is filed under its anchor, the place in it whose next
``GRAM`` bytes have the least hash; equal windows have equal anchors at equal offsets.
Windows of one anchor are neighbours, so one row a *block* (document, anchor, first and
last window) stands for about 75 of them. A block can only repeat if its anchor's gram
occurs twice; all grams are counted, and only blocks whose gram repeats go on.

The sort: a block's key is the text from its anchor to the end of its last window, then
the text before the anchor, backwards. Tasks sort their blocks' keys into runs, one a
bucket of the anchors' hashes, and exchange them front-coded (each key without the
prefix it shares with the one before). A bucket's runs are merged by a loser tree that
carries each run's common prefix with the last key put out: unequal prefixes decide
without looking at text, and equal ones are compared from there on. The merge yields
keys and their common prefixes in order. Equal keys are blocks that repeat whole; for
the others the same prefixes, to the right of the anchor and to the left of it, give
the windows that they share with some other block of the gram.

Hot grams: blocks of a gram that occurs over ``HOT`` times are cut into ranges of ``STEP``
offsets first, and only hashes of these are shuffled and counted with map-side combine. A
range whose whole text occurs twice is settled by that (128 bits of hash). A range that
shares with others the text which a match in it must hold, but isn't settled, straddles
the edge of a passage: it and one block of each settled range go on window by window,
filed under the whole window. So equal keys meet, and a key met twice in one task is
settled there; no bucket holds the many different keys around a passage that a third of
all documents hold.

Periodic texts: where a text repeats itself every few bytes all windows have the same gram,
so the anchors of a stretch of period p stand p bytes apart. A window that lies in such a
stretch p bytes behind another one repeats it, so the stretch is settled as one span, all
but its first p windows, which stay as a block that is known to occur twice.

Defined cases: a null text is empty; texts shorter than ``MATCH`` keep all; matches
never cross documents; rows equal in every column are repeats of each other; an empty
table gives an empty table. Rows are told apart by 128 bits of hashes of their columns.
Columns ``kept``, ``n_bytes``, ``n_removed``, ``n_spans`` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest, xxh64_intdigest

from contactweave.llm.common import stored, table

MATCH, GRAM = 200, 50
#: Windows are looked at in stretches of so many bytes.
STRETCH = 1 << 20
#: Bytes of keys a task holds for one run; blocks a bucket should get; occurrences that make a gram hot.
RUN_BYTES, BUCKET, HOT = 24 << 20, 8_000, 20_000
#: Offsets in one range of a hot block.
STEP = 13
BASE = 0x9E3779B97F4A7C15
RUNS = "bucket long, lcp binary, size binary, right binary, tails binary, copies binary, ids binary"
SPANS = "k1 long, k2 long, begin long, finish long"
RANGES = "k1 long, k2 long, anchor long, lo int, hi int, home long, h1 long, h2 long, n int"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Blocks of byte strings laid end to end, STRETCH bytes at most."""

    def __init__(self):
        n = STRETCH + 1
        self.up, self.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
        self.value = np.random.default_rng(200).integers(0, 1 << 64, 256, dtype=np.uint64)

    def blocks(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first window, last window, anchor, gram hash) of every block, places in ``data``; strings shorter than MATCH have none."""
        n, width = len(data), MATCH - GRAM + 1
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.value[data] * self.up[:n], out=run[1:])
        gram = (run[GRAM:] - run[:-GRAM]) * self.down[: n - GRAM + 1]
        gram = (gram ^ (gram >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        gram ^= gram >> np.uint64(32)
        low = (gram & np.uint64(~0xFFFFF & (1 << 64) - 1)) | np.arange(len(gram), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < width:
            low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
        ends = np.repeat(np.cumsum(sizes), sizes)[: len(low)]
        at = np.flatnonzero(np.arange(len(low)) + MATCH <= ends)
        anchor = (low[at] & np.uint64(0xFFFFF)).astype(np.int64)
        opens = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = at[np.concatenate([opens[1:] - 1, [len(at) - 1]])] if len(at) else at
        return at[opens], last, anchor[opens], gram[anchor[opens]].view(np.int64)


def settle_periods(data: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Which blocks stay, how many times each is known to occur, and the places (begin, finish) of the windows of those that go.

    Anchors of one gram at equal distances are a periodic stretch as far as the bytes between them say so.
    """
    stay, times, spans = np.ones(len(anchor), dtype=bool), np.ones(len(anchor), dtype=np.int32), []
    step = np.diff(anchor)
    link = (gram[1:] == gram[:-1]) & (first[1:] == last[:-1] + 1) & (step > 0) & (step <= MATCH - GRAM)
    for k, end in _runs_of(link, step):
        p = int(step[k])
        a, n = int(anchor[k]), end - k
        same = (data[a : a + n * p] == data[a + p : a + n * p + p]).reshape(n, p).all(axis=1)
        for i, j in _runs_of(same, np.zeros(n)):
            i, j = k + i, k + j
            # The last block whose windows all end inside the stretch.
            done = i + (int(anchor[j]) + p - MATCH - int(anchor[i])) // p
            if done >= i + 2:
                stay[i + 2 : done + 1] = False
                times[i + 1] = 2
                spans.append((int(first[i + 2]), int(last[done]) + MATCH))
    return stay, times, spans


def _runs_of(true: np.ndarray, value: np.ndarray) -> list[tuple[int, int]]:
    """(first, behind the last) of the runs of three and more true places of one value."""
    edge = np.flatnonzero(np.concatenate([[True], (true[1:] != true[:-1]) | (value[1:] != value[:-1]), [True]])) if len(true) else np.zeros(1, dtype=int)
    return [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if b - a >= 3 and true[a]]


def _stretches(raw: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes]]:
    """Texts in stretches that hold every window once: (text number, place in the text) of each part, and the bytes."""
    which, place, parts, held = [], [], [], 0
    for n, text in enumerate(raw):
        for at in range(0, max(0, len(text) - MATCH + 1), STRETCH - MATCH + 1):
            part = text[at : at + STRETCH]
            if held + len(part) > STRETCH:
                yield which, place, parts
                which, place, parts, held = [], [], [], 0
            which.append(n)
            place.append(at)
            parts.append(part)
            held += len(part)
    if parts:
        yield which, place, parts


def find_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, gram, where, times) of every block; ``where``: first window << 16 | last - first << 8 | anchor - first.

    Rows of ``times`` 0 are settled places instead, ``where``: begin << 21 | length; their ``gram`` only deals them out.
    """
    anchors = Anchors()
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
        keys = [batch.column(c).to_numpy() for c in ("k1", "k2")]
        for which, place, parts in _stretches(raw):
            sizes = np.array([len(p) for p in parts])
            data = np.frombuffer(b"".join(parts), dtype=np.uint8)
            first, last, anchor, gram = anchors.blocks(data, sizes)
            stay, times, spans = settle_periods(data, first, last, anchor, gram)
            first, last, anchor, gram, times = (x[stay] for x in (first, last, anchor, gram, times))
            opens, closes = np.array(spans, dtype=np.int64).reshape(-1, 2).T
            begin = np.cumsum(sizes) - sizes
            part = np.searchsorted(begin, np.concatenate([first, opens]), side="right") - 1
            at = np.concatenate([first, opens]) - begin[part] + np.array(place)[part]
            n = len(first)
            where = np.concatenate([at[:n] << 16 | (last - first) << 8 | anchor - first, at[n:] << 21 | closes - opens])
            text = np.array(which)[part]
            gram = np.concatenate([gram, keys[0][text[n:]] + at[n:]])
            columns = (keys[0][text], keys[1][text], gram, where, np.concatenate([times, np.zeros(len(opens), dtype=np.int32)]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["k1", "k2", "gram", "where", "times"])


def shared(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix of two strings that agree up to ``at``."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[at:n]) ^ int.from_bytes(b[at:n])
    return n - (x.bit_length() + 7) // 8


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(k1, k2, bytes, bytes backwards, blocks) of each row; a block is (gram, anchor, least offset, largest offset, many, alike)."""
    for batch in batches:
        for k1, k2, text, blocks in zip(*(batch.column(c) for c in ("k1", "k2", "text", "blocks")), strict=True):
            raw = text.as_py().encode()
            # Columns of the block list as arrays: no Python object a field.
            gram, where, many, alike = (blocks.values.field(c).to_numpy(zero_copy_only=False) for c in ("gram", "where", "many", "alike"))
            high = where & 255
            columns = (gram, (where >> 16) + high, high - (where >> 8 & 255), high, many, alike)
            yield k1.as_py(), k2.as_py(), raw, raw[::-1], zip(*(c.tolist() for c in columns), strict=True)


def hot_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of offsets of hot blocks: ``home``, a hash of what two blocks with a common window in the range must share; ``h1, h2``, of all the range's text."""
    for k1, k2, raw, back, blocks in _listed(batches):
        out = []
        for _, anchor, low, high, _, alike in blocks:
            for a in range(low - low % STEP, high + 1, STEP):
                b = min(a + STEP - 1, MATCH - GRAM)
                lo, hi = max(a, low), min(b, high)
                whole = xxh3_128_intdigest(raw[anchor - hi : anchor - lo + MATCH])
                home = xxh64_intdigest(raw[anchor : anchor - b + MATCH] + back[len(raw) - anchor : len(raw) - anchor + a], a)
                out.append((k1, k2, anchor, lo, hi, _signed(home), _signed(whole), _signed(whole >> 64), 1 + alike))
        cols = list(zip(*out, strict=True)) or [[]] * 9
        kinds = [pa.int32() if k in (3, 4, 8) else pa.int64() for k in range(9)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in RANGES.split(", ")])


def front_code(entries: list[tuple]) -> Iterator[tuple]:
    """Sorted entries (bucket, key, right, k1, k2, anchor, whole) as front-coded runs, one a bucket.

    Keys met twice are settled here: their places go out as a row of bucket < 0, and one key without places is sent on as met.
    """
    at, done = 0, []
    while at < len(entries):
        bucket = entries[at][0]
        lcp, size, right, tails, copies, ids, last = [], [], [], [], [], [], b""
        while at < len(entries) and entries[at][0] == bucket:
            key, r, end = entries[at][1], entries[at][2], at + 1
            while end < len(entries) and entries[end][:3] == (bucket, key, r):
                end += 1
            n = shared(last, key)
            met = end - at > 1 or entries[at][6]
            for k1, k2, anchor in (e[3:6] for e in entries[at:end]):
                if met:
                    done.append((k1, k2, anchor - len(key) + r, anchor + r))
                else:
                    ids.append((k1, k2, anchor))
            for column, x in ((lcp, n), (size, len(key)), (right, r), (tails, key[n:]), (copies, 2 if met else 1)):
                column.append(x)
            last, at = key, end
        short = [np.array(x, dtype=np.uint16).tobytes() for x in (lcp, size, right)]
        yield (bucket, *short, b"".join(tails), np.array(copies, dtype=np.uint8).tobytes(), np.array(ids, dtype=np.int64).tobytes())
    if done:
        yield (-1 - (done[0][0] & 0xFFFF), b"", b"", b"", b"", b"", np.array(done, dtype=np.int64).tobytes())


def make_runs(buckets: int):
    """Sorted, front-coded runs of the keys of documents' blocks."""

    def rows(entries: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*front_code(sorted(entries, key=lambda e: e[:3])), strict=True))
        types = [pa.int64()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in RUNS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, held = [], 0
        for k1, k2, raw, back, blocks in _listed(batches):
            for gram, anchor, low, high, many, alike in blocks:
                for lo, hi in [(o, o) for o in range(low, high + 1)] if many else [(low, high)]:
                    stop = anchor - lo + MATCH
                    key = raw[anchor:stop] + back[len(raw) - anchor : len(raw) - anchor + hi]
                    home = xxh64_intdigest(key, lo) if many else gram
                    entries.append((home % buckets, key, stop - anchor, k1, k2, anchor, alike))
                    held += len(key)
                if held >= RUN_BYTES:
                    yield rows(entries)
                    entries, held = [], 0
        if entries:
            yield rows(entries)

    return run


class Run:
    """A front-coded run, decoded key by key."""

    def __init__(self, lcp: bytes, size: bytes, right: bytes, tails: bytes, copies: bytes, ids: bytes):
        self.lcp, self.size, self.right = (np.frombuffer(x, dtype=np.uint16).tolist() for x in (lcp, size, right))
        self.tails, self.copies = tails, np.frombuffer(copies, dtype=np.uint8).tolist()
        self.ids = np.frombuffer(ids, dtype=np.int64).reshape(-1, 3)
        self.at, self.tail, self.id, self.key = -1, 0, 0, b""

    def step(self) -> bool:
        if self.at >= 0 and self.copies[self.at] == 1:
            self.id += 1
        self.at += 1
        if self.at == len(self.lcp):
            return False
        n = self.lcp[self.at]
        end = self.tail + self.size[self.at] - n
        self.key = self.key[:n] + self.tails[self.tail : end]
        self.tail = end
        return True


def merge(runs: list[Run]) -> Iterator[tuple[Run, int]]:
    """Runs in the order of their next keys, each with that key's common prefix with the last key put out.

    ``same[r]`` is the common prefix of run r's key and the key that last beat it. On the
    winner's path that is the last key put out, so the longer prefix is the smaller key.
    """
    size = 1
    while size < len(runs):
        size *= 2
    live = [r < len(runs) and runs[r].step() for r in range(size)]
    same = [0] * size
    losers = [-1] * size

    def beats(a: int, b: int) -> bool:
        """Run a before run b; leaves the loser's common prefix with the winner."""
        if not live[b]:
            return True
        if not live[a]:
            return False
        p, q = same[a], same[b]
        if p != q:
            return p > q
        x, y = runs[a], runs[b]
        n = shared(x.key, y.key, p)
        first = x.key[n : n + 1] < y.key[n : n + 1] if n < max(len(x.key), len(y.key)) else (x.right[x.at], a) < (y.right[y.at], b)
        same[b if first else a] = n
        return first

    def play(node: int) -> int:
        if node >= size:
            return node - size
        a, b = play(2 * node), play(2 * node + 1)
        won = a if beats(a, b) else b
        losers[node] = a + b - won
        return won

    top = play(1)
    while live[top]:
        run = runs[top]
        yield run, same[top]
        live[top] = run.step()
        if live[top]:
            same[top] = run.lcp[run.at]
        node = (top + size) // 2
        while node:
            if beats(losers[node], top):
                losers[node], top = top, losers[node]
            node //= 2


def shared_offsets(lcp: np.ndarray, right: np.ndarray, left: list[bytes], met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset at which each distinct key's window equals another key's, -1 for none.

    Windows of offset o are equal if their keys agree on MATCH - o bytes to the right of the anchor and on o bytes to the left.
    """
    n = len(lcp)
    least, most = np.full(n, -1), np.full(n, -1)
    low, high = MATCH - right, np.array([len(x) for x in left], dtype=np.int64)
    order = np.array(sorted(range(n), key=lambda k: left[k]), dtype=np.int64)
    left_lcp = np.array([0] + [shared(left[a], left[b]) for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)])
    left_class = np.empty(n, dtype=np.int64)
    for o in range(int(high.max()) + 1):
        valid = np.flatnonzero((low <= o) & (o <= high))
        if len(valid) < 2 or met[valid].all():
            continue
        left_class[order] = np.cumsum(left_lcp < o)
        both = np.cumsum(lcp < MATCH - o)[valid] * (n + 1) + left_class[valid]
        by = np.argsort(both, kind="stable")
        equal = both[by][1:] == both[by][:-1]
        hit = np.zeros(len(valid), dtype=bool)
        hit[by[1:][equal]] = True
        hit[by[:-1][equal]] = True
        at = valid[hit]
        least[at] = np.where(least[at] < 0, o, least[at])
        most[at] = o
    return least, most


def merge_bucket(rows: pa.Table) -> pa.Table:
    """Places (k1, k2, begin, finish) that repeat, from all runs of a bucket."""
    spans = []
    if rows["bucket"][0].as_py() < 0:
        spans = [np.frombuffer(x.as_py(), dtype=np.int64).reshape(-1, 4) for x in rows["ids"]]
    else:
        runs = [Run(*(rows[c][k].as_py() for c in ("lcp", "size", "right", "tails", "copies", "ids"))) for k in range(rows.num_rows)]
        keys, rights, lcps, met, ids, owner = [], [], [], [], [], []
        for run, n in merge(runs):
            if not keys or n < len(run.key) or keys[-1] != run.key or rights[-1] != run.right[run.at]:
                keys.append(run.key)
                rights.append(run.right[run.at])
                lcps.append(n)
                met.append(0)
            met[-1] += run.copies[run.at]
            if run.copies[run.at] == 1:
                ids.append(run.id)
                owner.append((len(keys) - 1, run))
        if ids:
            place = np.array([r.ids[i] for (_, r), i in zip(owner, ids, strict=True)])
            key = np.array([k for k, _ in owner])
            right, size, whole = np.array(rights), np.array([len(k) for k in keys]), np.array(met) > 1
            low, high = MATCH - right, size - right
            group = np.cumsum(np.array(lcps) < GRAM) - 1
            alone = np.bincount(group, minlength=1)
            look = np.flatnonzero((alone[group] > 1) & (np.bincount(group, weights=~whole) > 0)[group])
            least, most = np.where(whole, low, -1), np.where(whole, high, -1)
            if len(look):
                some = look[~whole[look]]
                a, b = shared_offsets(np.array(lcps)[look], right[look], [keys[k][rights[k] :] for k in look.tolist()], whole[look])
                back = np.full(len(keys), -1)
                back[look] = np.arange(len(look))
                least[some], most[some] = a[back[some]], b[back[some]]
            hit = least[key] >= 0
            key, place = key[hit], place[hit]
            spans = [np.column_stack([place[:, 0], place[:, 1], place[:, 2] - most[key], place[:, 2] - least[key] + MATCH])]
    all_ = np.concatenate(spans) if spans else np.empty((0, 4), dtype=np.int64)
    return pa.Table.from_arrays([pa.array(all_[:, k]) for k in range(4)], names=["k1", "k2", "begin", "finish"])


def _meet(keyed: DataFrame, by_document: DataFrame, how: str) -> DataFrame:
    """``keyed`` with the row of its document, under names that can't clash with its own."""
    other = by_document.withColumnsRenamed({"k1": "_cw_j1", "k2": "_cw_j2"})
    return keyed.join(other, (F.col("_cw_k1") == F.col("_cw_j1")) & (F.col("_cw_k2") == F.col("_cw_j2")), how).drop("_cw_j1", "_cw_j2")


def _keyed(df: DataFrame, text: str) -> DataFrame:
    columns = [F.col(c) for c in df.columns]
    others = [c for c, n in zip(columns, df.columns, strict=True) if n != text]
    plain = F.to_json(F.struct(*others)) if others else F.lit("")
    t = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns({"_cw_k1": F.xxhash64(plain, t), "_cw_k2": F.xxhash64(t, F.lit("second"), plain)})


def _with_blocks(keyed: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """Documents that have blocks in ``found``, with the list of these."""
    lists = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "where", "many", "alike")).alias("_cw_blocks"))
    named = {"_cw_k1": "k1", "_cw_k2": "k2", text: "text"}
    return _meet(keyed, lists, "inner").select(*[F.col(c).alias(named.get(c, f"_cw_{c}")) for c in keyed.columns], F.col("_cw_blocks").alias("blocks"))


def _hot(keyed: DataFrame, text: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of blocks of hot grams: the settled places, and what goes on window by window, as blocks."""
    key = ["home", "h1", "h2", "lo", "hi"]
    ranges = stored(_with_blocks(keyed, text, hot).mapInArrow(hot_ranges, RANGES), "ranges")
    # Each step is stored, so that joins have plain shuffles on both sides and a very frequent range can be split.
    wholes = stored(ranges.groupBy(*key).agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "anchor")).alias("first")), "wholes")
    kinds = stored(wholes.groupBy("home").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("home", F.lit(True).alias("mixed")), "kinds")
    flags = stored(wholes.join(kinds, "home", "left").select(*key, (F.col("n") > 1).alias("met"), F.coalesce("mixed", F.lit(False)).alias("mixed"), "first").filter("met OR mixed"), "flags")
    ranges = stored(ranges.join(flags, key), "ranges")
    settled = ranges.filter("met").select("k1", "k2", (F.col("anchor") - F.col("hi")).alias("begin"), (F.col("anchor") - F.col("lo") + MATCH).alias("finish"))
    open_ = ranges.filter(F.col("mixed") & (~F.col("met") | (F.col("first") == F.struct("k1", "k2", "anchor"))))
    where = F.expr("shiftleft(anchor - hi, 16) + (hi - lo) * 256 + hi")
    return settled, open_.select("k1", "k2", F.lit(0).cast("long").alias("gram"), where.cast("long").alias("where"), F.lit(True).alias("many"), F.col("met").alias("alike"))


def _runs(keyed: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """The runs to merge, and places settled before."""
    plain = keyed.select(F.col("_cw_k1").alias("k1"), F.col("_cw_k2").alias("k2"), F.col(text).alias("text"))
    blocks = plain.mapInArrow(find_blocks, "k1 long, k2 long, gram long, where long, times int")
    # Stored: the join below then has plain shuffles on both sides, and a very frequent gram's blocks can be split.
    grams = stored(blocks.filter("times > 0").groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "grams")
    # Dealt by document before blocks are grouped: grouping on top of the join would keep a gram's blocks in one task.
    met = blocks.join(grams, "gram", "left").filter("n IS NOT NULL OR times = 0")
    found = met.repartition("k1", "k2").groupBy("k1", "k2", "gram", "where").agg(F.sum("times").alias("m"), F.first("n").alias("n"))
    found = stored(found.select("k1", "k2", "gram", "where", F.coalesce(F.col("n") > HOT, F.lit(False)).alias("many"), (F.col("m") > 1).alias("alike"), (F.col("m") == 0).alias("span")), "blocks")
    begin = F.shiftright("where", 21)
    settled = found.filter("span").select("k1", "k2", begin.alias("begin"), (begin + F.col("where").bitwiseAND(F.lit((1 << 21) - 1))).alias("finish"))
    found = found.filter("NOT span").drop("span")
    total, hot = found.agg(F.count("*"), F.count_if("many")).first()
    if hot:
        ranges, windows = _hot(keyed, text, found.filter("many"))
        settled = settled.unionByName(ranges)
        windows = stored(windows, "windows")
        total += STEP * windows.count() - hot
        found = found.filter("NOT many").unionByName(windows)
    return _with_blocks(keyed, text, found).mapInArrow(make_runs(max(8, total // BUCKET)), RUNS), settled


def _spans(keyed: DataFrame, text: str) -> DataFrame:
    """(k1, k2, begin, finish) of repeated places, unmerged."""
    runs, settled = _runs(keyed, text)
    return runs.groupBy("bucket").applyInArrow(merge_bucket, SPANS).unionByName(settled)


def cut(text: Column, spans: Column, as_text: bool = False) -> Column:
    """Struct (kept, n_bytes, n_removed, n_spans) of a text without its spans: the bytes kept, or as text without characters cut in two."""
    kind = "string" if as_text else "binary"

    @F.arrow_udf(f"struct<kept: {kind}, n_bytes: long, n_removed: long, n_spans: long>")
    def of(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for t, spans in zip(texts, lists, strict=True):
            raw, kept, at, runs = (t.as_py() or "").encode(), [], 0, 0
            done = -1
            for s in sorted((s["begin"], s["finish"]) for s in spans.as_py() or ()):
                if s[0] > done:
                    kept.append(raw[at : s[0]])
                    runs += 1
                done = at = max(done, s[1])
            kept.append(raw[at:])
            rest = b"".join(kept)
            out.append((rest.decode(errors="ignore") if as_text else rest, len(raw), len(raw) - len(rest), runs))
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.StructArray.from_arrays([pa.array(cols[0], pa.string() if as_text else pa.binary())] + [pa.array(c, pa.int64()) for c in cols[1:]], names=["kept", "n_bytes", "n_removed", "n_spans"])

    return of(text, spans)


def remove_repeats(df: DataFrame, text: str = "text", as_text: bool = False) -> DataFrame:
    """``df`` with ``kept`` (the remaining bytes, or as text without characters cut in two), ``n_bytes``, ``n_removed``, ``n_spans``."""
    keyed = _keyed(df, text)
    spans = _spans(keyed, text).groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "finish")).alias("_cw_spans"))
    joined = _meet(keyed, spans, "left").drop("_cw_k1", "_cw_k2")
    out = joined.withColumn("_cw_cut", cut(F.col(text), F.col("_cw_spans"), as_text))
    return out.withColumns({c: F.col(f"_cw_cut.{c}") for c in ("kept", "n_bytes", "n_removed", "n_spans")}).drop("_cw_cut", "_cw_spans")


def op2_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
