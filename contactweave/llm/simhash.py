"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint is the bitwise majority of the hashes of its word shingles.
Fingerprints within radius r are found without a miss: every bit gets a vector of
GF(2)^(r+1) and table v, for each of the 2^(r+1)-1 vectors v other than 0, compares
the bits whose vector has an odd product with v. r differing bits put r linear
conditions on v, which r+1 dimensions always leave a solution: in that table all are
masked out and the pair collides. Only distinct fingerprints are compared.

A bucket of more than ``LARGE`` distinct fingerprints is covered again by a second
family of masks, which leaves about a quarter of the bits free: with radius 2 these
are 16 bits, and no bucket ever holds more than 65536 values. A bucket gives the
links of a spanning forest of its near pairs, never all of them.

For the pipeline's stage near-duplicates are texts whose sets of 5-word shingles have a
Jaccard similarity of 0.8 or more, where fingerprints differ in 10 bits and more. There
candidates meet in the tables of the covering or in one of ``BANDS`` further independent
fingerprints of ``ROWS`` least hashes each (missed at 0.8: one pair in 16,000), and every
link is confirmed by the sets themselves. Groups are told apart by their root, not by
their smallest key, which several may share.

Defined cases: a null text has no words (fingerprint 0, linked like any other; in the
pipeline's stage the empty set, equal to itself); a null id never is a component's name
unless all its ids are null; repeated rows share a component; rows of one id and different
texts are told apart; very long texts are hashed whole, in slices of bounded memory; of a
group's rows the one of the smallest (id, text hash, hash of all columns) stays, null ids last; an empty table
gives an empty table; columns ``fingerprint`` and ``component_id`` of the input are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.llm.common import stored, table
from contactweave.operators.components import components

RADIUS = 2
#: Bytes of a text whose words are held at once.
STRETCH = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: A bucket of more distinct fingerprints is divided again.
LARGE = 4096
#: Keys of the pipeline's stage: so many bands of so many least hashes; sets of two blocks are compared in one task.
BANDS, ROWS, BLOCK, TURNS = 32, 6, 256, 2
#: Keys of more sets that stay apart go by their rarest shingles.
MANY = 512


def _product(v: int, w: int) -> bool:
    return bool((v & w).bit_count() & 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@lru_cache(maxsize=16)
def covering_masks(radius: int, family: int = 0) -> list[int]:
    """The 2^(radius+1)-1 masks over 64 bits, as signed values; two families deal the vectors to the bits in two ways.

    Bit k gets the last bits of k, for radius 6 behind a 1 (a first-order Reed-Muller code): every mask but that of
    all bits compares 32 of them.
    """
    if not 0 <= radius <= 6:
        raise ValueError("64 bits hold masks for a radius from 0 to 6")
    size = 2 << radius
    place = [k if family == 0 else k // 8 if radius <= 2 else k * 37 % 64 for k in range(64)]
    vector = [(64 | k) % size if size > 64 else k % size for k in place]
    return [_signed(sum(1 << b for b, w in enumerate(vector) if _product(v, w))) for v in range(1, size)]


def first_hash(shingle: bytes) -> int:
    return xxhash.xxh64_intdigest(shingle, 42)


def word_lists(text: str | None, size: int) -> Iterator[list[bytes]]:
    """The text's words, A-Z in lower case, in lists that hold every run of ``size`` words once; a shorter text is one list, one without words none.

    A list comes from about ``STRETCH`` bytes, however long the text.
    """
    raw, at, carry, whole = (text or "").encode().lower(), 0, [], True
    while at < len(raw):
        blank = BLANK.search(raw, at + STRETCH) if at + STRETCH < len(raw) else None
        end = blank.start() if blank else len(raw)
        carry += raw[at:end].split()
        at = end
        if len(carry) >= size:
            yield carry
            carry, whole = carry[len(carry) - size + 1 :], False
    if whole and carry:
        yield carry


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the highest first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of one text."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for words in word_lists(text, shingle):
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        joined = b" ".join(words)
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        last = min(shingle, len(words)) - 1
        hashes = [first_hash(joined[a:b]) for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)]
        ones += _set_bits(np.array(hashes, dtype=np.uint64))
        n += len(hashes)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([_signed(fingerprint_of(t, shingle)) for t in texts.to_pylist()], pa.int64())

    return of(text)


def near_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of distinct values that differ in at most ``radius`` bits."""
    if len(values) == 2:
        a, b = values
        return [(a, b)] if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius else []
    left = np.array(values, dtype=np.int64).view(np.uint64)
    out, edge = [], []
    while edge or len(left):
        if not edge:
            edge, left = [left[-1]], left[:-1]
        at = edge.pop()
        near = np.bitwise_count(left ^ at) <= radius
        if near.any():
            out += [(_signed(int(at)), _signed(int(x))) for x in left[near]]
            edge += list(left[near])
            left = left[~near]
    return out


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect whatever the pairs within ``radius`` of the distinct values of column ``fp`` connect."""

    def bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [p for values in batch.column("fps").to_pylist() for p in near_links(values, radius)]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    first, second = (F.posexplode(F.array(*map(F.lit, covering_masks(radius, k)))).alias("t", "m") for k in (0, 1))
    # Values that share a key by chance fail the comparison.
    key = lambda *of: F.xxhash64(*of, F.col("fp").bitwiseAND(F.col("m"))).alias("k")
    rows = prints.select("fp", first).select("fp", key("t"))
    met = rows.withColumn("n", F.count("*").over(Window.partitionBy("k"))).filter("n > 1")
    large = met.filter(F.col("n") > LARGE).select("fp", "k", second).select("fp", key("k", "t"))
    buckets = met.filter(F.col("n") <= LARGE).select("fp", "k").unionByName(large)
    lists = buckets.groupBy("k").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1").select("fps")
    return lists.mapInArrow(bucket_links, "a long, b long").distinct()


def simhash_components(rows: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """For rows of a key and a long ``fingerprint``: (fp, root, component_id); ``root`` is the component's own, ``component_id`` the smallest key it reaches."""
    prints = stored(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(key).alias("low")), "prints")
    roots = components(near_pairs(prints.select("fp"), radius))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    # Stored: the join below then has plain shuffles on both sides, and a very large component's rows can be split.
    names = stored(named.groupBy("root").agg(F.min("low").alias("component_id")), "names")
    return named.join(names, "root").select("fp", "root", "component_id")


def simhash_groups(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id), a row for each row of ``df``."""
    rows = stored(df.select(F.col(key), fingerprint(F.col(text), shingle).alias("fingerprint")), "fingerprints")
    groups = simhash_components(rows, key, radius)
    joined = rows.join(groups, rows["fingerprint"] == groups["fp"])
    return joined.select(key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


class WordHashes(dict):
    """Hashes of words, remembered up to ``most`` of them."""

    def __init__(self, most: int = 1 << 19):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        out = first_hash(word)
        if len(word) <= 40:
            self[word] = out
        return out


@lru_cache(maxsize=4)
def _hashing(words: int) -> tuple[WordHashes, np.ndarray, np.ndarray]:
    """The worker's word hashes, a factor for each place in a shingle, and one for each least hash."""
    rng = np.random.default_rng(5)
    return WordHashes(), rng.integers(0, 1 << 63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one shingle, one without words has none."""
    seen, place, _ = _hashing(words)
    parts = [np.empty(0, dtype=np.uint64)]
    for own in word_lists(text, words):
        of_word = np.fromiter(map(seen.__getitem__, own), dtype=np.uint64, count=len(own))
        size = min(words, len(own))
        mixed = np.full(len(own) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            mixed += of_word[k : k + len(mixed)] * place[k]
        for _ in range(2):
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
        parts.append(mixed ^ (mixed >> np.uint64(32)))
    return np.unique(np.concatenate(parts))


def meeting_keys(shingles: np.ndarray, words: int = 5) -> np.ndarray:
    """Keys of a set of shingles: SimHash covered for RADIUS bits, and BANDS of ROWS least hashes each, equal in two sets with probability J**ROWS."""
    ones = np.zeros(64, dtype=np.int64)
    factors = _hashing(words)[2]
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(shingles), 1024):
        some = shingles[at : at + 1024]
        ones += _set_bits(some)
        least = np.minimum(least, ((some >> np.uint64(32)).astype(np.uint32)[:, None] * factors).min(axis=0))
    print_ = int(np.packbits(2 * ones > len(shingles)).view(">u8")[0])
    keys = [xxhash.xxh64_intdigest(f"{t} {print_ & m & (1 << 64) - 1}") for t, m in enumerate(covering_masks(RADIUS))]
    raw = least.tobytes()
    keys += [xxhash.xxh64_intdigest(raw[4 * t * ROWS : 4 * (t + 1) * ROWS], t + 1) for t in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64)


def _set_columns(text: Column, words: int) -> Column:
    @F.arrow_udf("struct<sid: long, keys: array<long>>")
    def of(texts: pa.Array) -> pa.Array:
        sets = [shingle_set(t, words) for t in texts.to_pylist()]
        sids = pa.array([_signed(xxhash.xxh64_intdigest(s.tobytes(), 7)) for s in sets], pa.int64())
        return pa.StructArray.from_arrays([sids, pa.array([meeting_keys(s, words) for s in sets], pa.list_(pa.int64()))], names=["sid", "keys"])

    return of(text)


def _set_of(text: Column, words: int) -> Column:
    @F.arrow_udf("array<long>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t, words).view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))

    return of(text)


def near_sets(sets: list[np.ndarray], labels: list[int], least: tuple[int, int]) -> list[tuple[int, int]]:
    """Pairs (places) of sets of Jaccard similarity ``least`` (a fraction) or more that connect all labels such pairs connect."""
    up, down = least
    size = np.array([len(s) for s in sets], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(flat) + 1, dtype=np.int64)
    label, out = np.unique(labels, return_inverse=True)[1], []
    for k in range(len(sets)):
        if (label == label[0]).all():
            break
        own = flat[begin[k] : begin[k + 1]]
        mark[own] = 1
        common = np.diff(np.concatenate([[0], np.cumsum(mark[flat])])[begin])
        mark[own] = 0
        for j in np.flatnonzero((down + up) * common >= up * (size + size[k])):
            if label[j] != label[k]:
                out.append((k, int(j)))
                label[label == label[j]] = label[k]
    return out


def _open_keys(labelled: DataFrame) -> DataFrame:
    """(k, n) of the keys whose sets (k, sid, label) are in several components; counted with map-side combine."""
    return stored(labelled.groupBy("k").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("k", "n"), "open")


def _block_links(labelled: DataFrame, keys: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Links (a, b) of the sets of each key (k, n), BLOCK by BLOCK sets a task."""

    def block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.column("rows"):
                rows = row.values
                sids, labels = (rows.field(c).to_pylist() for c in ("sid", "label"))
                found += [(sids[x], sids[y]) for x, y in near_sets([s.values.to_numpy() for s in rows.field("set")], labels, least)]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    rows = labelled.join(keys.select("k", F.ceil(F.col("n") / BLOCK).alias("g")), "k").withColumn("i", F.pmod(F.xxhash64("sid", F.lit("block")), F.col("g")))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1))).select("k", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "sid", "label")
    lists = rows.join(sets, "sid").groupBy("k", "i", "j").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.collect_list(F.struct("sid", "label", "set")).alias("rows")).filter("lo <> hi")
    return stored(lists.select("rows").mapInArrow(block_links, "a long, b long"), "links")


def rare_shingles(labelled: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(k, sid, label): each set under its rarest shingles, so many that two sets of similarity ``least`` have one of them in common.

    Of a set of m shingles these are the first m - ceil(least * m) + 1 in one order of all shingles: of two similar
    sets' common shingles, the first is among both's. Shingles of one set only come first and need no row.
    """
    up, down = least
    own = labelled.select("sid", "label").distinct().join(sets, "sid").select("sid", "label", F.size("set").alias("m"), F.explode("set").alias("s"))
    often = stored(own.groupBy("s").agg(F.count("*").alias("n")).filter("n > 1"), "often")
    lists = own.join(often, "s").groupBy("sid", "label", "m").agg(F.array_sort(F.collect_list(F.struct("n", "s"))).alias("x"))
    first = F.greatest(F.lit(0), F.expr(f"m - ({up} * m + {down} - 1) div {down} + 1 - (m - size(x))")).cast("int")
    return stored(lists.select("sid", "label", F.explode(F.slice("x", F.lit(1), first)).alias("y")).select(F.col("y.s").alias("k"), "sid", "label"), "rare")


def set_links(met: DataFrame, sets: DataFrame, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """(node, root) of the components of all pairs of sets that share a key (``met``: k, sid) and have Jaccard similarity ``least``.

    First every set is held against one representative a key, which joins large groups of near copies at a cost that grows
    with their size; these turns only save work. Keys whose sets are still in several components then have all their pairs
    looked at, BLOCK by BLOCK sets a task. Keys of more than MANY such sets, say of texts that share a long passage, would
    cost their square: their sets meet again under their rarest shingles instead, which loses no pair.
    """
    up, down = least
    links, roots = None, None
    a, b = (sets.select(F.col("sid").alias(c), F.col("set").alias(f"{c}_set")) for c in "ab")
    for turn in range(TURNS):
        labelled = met.withColumn("label", F.col("sid")) if roots is None else _labelled(met, roots)
        # Aggregated with map-side combine, then joined: no window holds a key's rows.
        heads = stored(labelled.groupBy("k").agg(F.min_by(F.struct("sid", "label"), F.xxhash64("sid", F.lit(turn))).alias("head"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("k", "head.*").withColumnsRenamed({"sid": "b", "label": "b_label"}), "heads")
        pairs = stored(labelled.join(heads, "k").filter("label <> b_label").select(F.col("sid").alias("a"), "b").distinct(), "pairs")
        near = pairs.join(a, "a").join(b, "b").filter((down + up) * F.size(F.array_intersect("a_set", "b_set")) >= up * (F.size("a_set") + F.size("b_set")))
        new = stored(near.select("a", "b"), "links")
        links = new if links is None else links.unionByName(new)
        roots = stored(components(links), "roots")

    labelled = _labelled(met, roots)
    keys = _open_keys(labelled)
    links = links.unionByName(_block_links(labelled, keys.filter(F.col("n") <= MANY), sets, least))
    large = keys.filter(F.col("n") > MANY)
    if not large.isEmpty():
        rare = rare_shingles(labelled.join(large, "k"), sets, least)
        links = links.unionByName(_block_links(rare, _open_keys(rare), sets, least))
    return components(links)


def _labelled(met: DataFrame, roots: DataFrame) -> DataFrame:
    return met.join(roots, met["sid"] == roots["node"], "left").select("k", "sid", F.coalesce("root", "sid").alias("label"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """``df`` with one row of each near-duplicate group: that of the smallest (key, text hash, hash of all columns), null keys last.

    Near-duplicates have sets of word shingles of Jaccard similarity ``least`` or more; a group is what such pairs connect.
    """
    whole = {"_cw_key": F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id")), "_cw_text": F.xxhash64(text), "_cw_row": F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in df.columns if c != text])))}
    names = list(whole)
    rows = df.select(*[c.alias(k) for k, c in whole.items()], _set_columns(F.col(text), words).alias("x"))
    rows = stored(rows.select(*names, "x.*"), "shingles")
    keyed = rows.groupBy("sid").agg(F.first("keys").alias("keys")).select("sid", F.explode("keys").alias("k"))
    often = stored(keyed.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1").select("k"), "keys")
    met = stored(keyed.join(often, "k").select("k", "sid"), "met")
    # The sets themselves are made again, for the few texts that meet another.
    first = rows.join(met.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.min(F.struct("_cw_key", "_cw_text")).alias("x")).select("sid", "x.*")
    sets = df.select(*[c.alias(k) for k, c in whole.items()], F.col(text).alias("_cw_of")).join(first, ["_cw_key", "_cw_text"]).dropDuplicates(["sid"])
    sets = stored(sets.select("sid", _set_of(F.col("_cw_of"), words).alias("set")), "sets")
    roots = set_links(met, sets, least)
    named = rows.select(*names, "sid").join(roots, rows["sid"] == roots["node"], "left").select(*names, F.coalesce("root", "sid").alias("root"))
    # A group is its root: groups of one smallest key stay apart.
    best = named.groupBy("root").agg(F.min(F.struct(*names)).alias("x")).select(*[f"x.{c}" for c in names]).distinct()
    kept = df.withColumns(whole).join(best, names, "left_semi")
    return kept.dropDuplicates(names).select(df.columns)


def op5_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
