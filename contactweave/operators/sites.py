"""Motif hits and the merged windows around them.

Sequences are searched as chunks (``sources.chunks``), all motifs in one pass of an
automaton over each chunk, so a scan's time doesn't grow with the number of motifs and no
sequence has to fit a row. Hits of one motif don't overlap: of a chain of overlapping
occurrences the first is taken, then the next that is free. Only a motif that begins as it
ends can overlap itself, and only a chain that runs over a chunk's edge needs to know how
it came in: its occurrences carry, as bits, at which first free places they are taken, and
a chunk that such a chain leaves says where it leaves for each place it may come in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactweave.functions.storage import stored
from contactweave.sources.chunks import OVERLAP, chunked

#: ``taken``: bit e is set if the hit counts when the chunk's first free place is e; ``leaves``: on rows without a place, the next chunk's first free place for each e. Rows without a motif: a chunk's size.
HITS = "contig_id int, chunk int, motif string, pos long, taken long, leaves binary"
EACH = -1
LOWER = re.compile("[a-z]+")
#: Bases of a segment of windows that are merged in one task.
SEGMENT = 1 << 20


@lru_cache(maxsize=8)
def _automaton(motifs: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for motif in motifs:
        found.add_word(motif, motif)
    found.make_automaton()
    return found


def overlaps_itself(motif: str) -> bool:
    return any(motif.startswith(motif[k:]) for k in range(1, len(motif)))


def free_hits(places: list[int], size: int, own: int) -> tuple[list[tuple[int, int]], bytes | None]:
    """((place, bits) of the occurrences that may count; where the next chunk is free for each place this one may be, if that isn't its start).

    ``places``: all occurrences of a motif of ``size`` letters that begin in a chunk's ``own`` letters, in order.
    """
    # First free place for each way to come in; ways that have met stay together.
    free, out, met = list(range(size)), [], False
    for at in places:
        if met or at >= max(free):
            met = True
            if at >= free[0]:
                out.append((at, EACH))
                free = [at + size] * size
            continue
        bits = sum(1 << e for e, f in enumerate(free) if at >= f)
        if bits:
            out.append((at, bits if bits != (1 << size) - 1 else EACH))
            free = [at + size if bits >> e & 1 else f for e, f in enumerate(free)]
    leaves = [max(0, f - own) for f in free]
    return out, bytes(leaves) if any(leaves) else None


def _search(motifs: tuple[str, ...], case_compat: bool):
    knotted = {m for m in motifs if overlaps_itself(m)}
    names = [x.split()[0] for x in HITS.split(", ")]
    types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(motifs)
        for batch in batches:
            for contig, chunk, start, own, seq in zip(*(batch.column(c).to_pylist() for c in ("contig_id", "chunk", "start", "own", "seq")), strict=True):
                if not case_compat:
                    # Letters outside ASCII may get longer in upper case.
                    seq = seq.upper() if seq.isascii() else LOWER.sub(lambda m: m[0].upper(), seq)
                motif_of, places = [], []
                chains: dict[str, list[int]] = {m: [] for m in knotted}
                # An occurrence that begins behind the chunk's own bases is the next chunk's.
                for end, motif in automaton.iter(seq):
                    at = end + 1 - len(motif)
                    if at < own:
                        if motif in knotted:
                            chains[motif].append(at)
                        else:
                            motif_of.append(motif)
                            places.append(at + start)
                taken, leaves = [EACH] * len(places), [None] * len(places)
                for motif, found in chains.items():
                    hits, left = free_hits(found, len(motif), own)
                    motif_of += [motif] * len(hits)
                    places += [at + start for at, _ in hits]
                    taken += [bits for _, bits in hits]
                    leaves += [None] * len(hits)
                    if left:
                        motif_of.append(motif)
                        places.append(None)
                        taken.append(None)
                        leaves.append(left)
                # The chunk's size, as a row without a motif.
                n = len(places) + 1
                columns = ([contig] * n, [chunk] * n, [*motif_of, None], [*places, own], [*taken, None], [*leaves, None])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def _comes_in(group: pd.DataFrame) -> pd.DataFrame:
    """First free place of the chunks behind those (contig_id, motif, chunk, leaves) that a chain leaves."""
    out, last, place = [], None, 0
    for contig, motif, chunk, leaves in group.sort_values("chunk")[["contig_id", "motif", "chunk", "leaves"]].itertuples(index=False):
        place = leaves[place if last == chunk - 1 else 0]
        last = chunk
        out.append((contig, motif, chunk + 1, place))
    return pd.DataFrame(out, columns=["contig_id", "motif", "chunk", "free"])


def search(sequences: DataFrame, motifs: list[str], case_compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """(contig_id, motif, pos) of every hit of every motif, pos from 0 in its contig, and (contig_id, length): of one scan of chunks or sequences, stored."""
    if max(map(len, motifs)) > OVERLAP:
        raise ValueError(f"motifs of more than {OVERLAP} bases")
    found = stored(as_chunks(sequences).mapInArrow(_search(tuple(dict.fromkeys(motifs)), case_compat), HITS), "hits")
    sizes = found.filter("motif IS NULL").groupBy("contig_id").agg(F.sum("pos").alias("length"))
    hits = found.filter("motif IS NOT NULL AND pos IS NOT NULL")
    if any(map(overlaps_itself, motifs)):
        # A contig's chunks that a chain of one motif leaves: a row a chunk at most.
        free = found.filter("leaves IS NOT NULL").groupBy("contig_id", "motif").applyInPandas(_comes_in, "contig_id int, motif string, chunk int, free int")
        open_ = hits.filter(F.col("taken") != EACH).join(free, ["contig_id", "motif", "chunk"], "left")
        open_ = open_.filter(F.expr("shiftright(taken, coalesce(free, 0)) & 1") == 1)
        columns = ["contig_id", "motif", "pos"]
        return hits.filter(F.col("taken") == EACH).select(columns).unionByName(open_.select(columns)), sizes
    return hits.select("contig_id", "motif", "pos"), sizes


def motif_hits(sequences: DataFrame, motifs: list[str], case_compat: bool = False) -> DataFrame:
    return search(sequences, motifs, case_compat)[0]


def as_chunks(sequences: DataFrame) -> DataFrame:
    """Chunks as they are, whole sequences (contig_id, seq) cut to chunks."""
    return sequences if "chunk" in sequences.columns else chunked(sequences)


def hit_counts(hits: DataFrame, sizes: DataFrame, motifs: list[str]) -> DataFrame:
    """(contig_id, length, re_count) from hits (contig_id, motif, pos) and (contig_id, length): the hits of ``motifs``, one listed twice counted twice, plus one."""
    times = {m: motifs.count(m) for m in motifs}
    weight = F.create_map(*[F.lit(x) for pair in times.items() for x in pair])[F.col("motif")]
    counts = hits.filter(F.col("motif").isin(list(times))).groupBy("contig_id").agg(F.sum(weight).alias("n"))
    return sizes.join(counts, "contig_id", "left").select("contig_id", "length", (F.coalesce("n", F.lit(0)) + 1).cast("int").alias("re_count"))


def site_counts(sequences: DataFrame, motifs: list[str], weight_motifs: list[str] | None = None, case_compat: bool = False) -> DataFrame:
    """(contig_id, length, re_count): hits of the weight motifs, else the motifs, plus one; letters of either case, unless ``case_compat``."""
    counted = weight_motifs or motifs
    return hit_counts(*search(sequences, counted, case_compat), counted)


def site_positions(sequences: DataFrame, motifs: list[str], case_compat: bool = False) -> DataFrame:
    """(contig_id, motif, pos, length) of every hit, 0-based, with its sequence's length; one row a hit, however often a motif is listed."""
    hits, sizes = search(sequences, motifs, case_compat)
    return hits.join(sizes, "contig_id")


def site_windows(positions: DataFrame, half: int = 500, segment: int = SEGMENT) -> DataFrame:
    """(contig_id, start, end): windows of ``half`` bases on both sides of the hits (contig_id, pos, length), overlapping ones merged.

    Two windows merge if one starts before the other ends; touching ones stay apart. Hits are sorted a segment
    of a contig at a time; how far the segments in front reach, and how many islands they open, are carried
    over from one row a segment.
    """
    of = ["contig_id", "_cw_segment"]
    sites = positions.select("contig_id", "pos", "length").distinct()
    end = F.when(F.col("pos") > F.col("length") - half, F.col("length")).otherwise(F.col("pos") + half)
    sites = stored(sites.select("contig_id", F.greatest(F.lit(0), F.col("pos") - half).alias("start"), end.alias("end"), F.floor(F.col("pos") / segment).alias("_cw_segment")), "sites")
    before = Window.partitionBy("contig_id").orderBy("_cw_segment").rowsBetween(Window.unboundedPreceding, -1)
    reach = sites.groupBy(*of).agg(F.max("end").alias("reach")).withColumn("carried", F.max("reach").over(before)).drop("reach")
    order = Window.partitionBy(*of).orderBy("start", "end")
    inside = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    sites = sites.join(reach, of).withColumn("reach", F.greatest(inside, "carried"))
    sites = sites.withColumn("opens", (F.col("reach").isNull() | (F.col("start") >= F.col("reach"))).cast("int"))
    sites = stored(sites.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))), "islands")
    first = sites.groupBy(*of).agg(F.sum("opens").alias("opens")).select(*of, F.coalesce(F.sum("opens").over(before), F.lit(0)).alias("first"))
    numbered = sites.join(first, of).withColumn("island", F.col("island") + F.col("first"))
    return numbered.groupBy("contig_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")
