"""Filters and joins over mapped read pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactweave.functions.watch import Watch

#: Unmapped, mate unmapped, secondary, failed quality, duplicate, supplementary.
BAD_FLAGS = 4 + 8 + 256 + 512 + 1024 + 2048


def quality_ok(min_mapq: int = 40) -> Column:
    mapq = F.col("mapq")
    return (mapq != 0) & (mapq != 255) & (mapq >= min_mapq)


def flags_ok(bad: int = BAD_FLAGS) -> Column:
    return F.col("flag").cast("int").bitwiseAND(F.lit(bad)) == 0


#: Bin sizes by read length: a read goes by the first bin that is longer than it. The last holds any contig.
BINS = (1 << 14, 1 << 20, 1 << 31)


def in_windows(reads: DataFrame, windows: DataFrame, read_length: Column) -> DataFrame:
    """Reads whose first mate overlaps a window of its contig, both ends inclusive.

    Reads and windows meet on (contig, bin size, bin of the read's start), so a contig with
    many windows or most of the reads is spread over its bins. A window is listed in every
    bin where a read that reaches it may start, a few rows a window; reads of any length are
    read once and never multiplied.
    """
    size = lambda k: F.lit(BINS[k]).cast("long")

    def bins(k: int) -> Column:
        inside = F.sequence(F.floor((F.col("start") - size(k)) / size(k)), F.floor(F.col("end") / size(k)))
        return F.transform(inside, lambda x: F.struct(F.lit(k).alias("level"), x.alias("bin")))

    listed = windows.select("contig_id", F.col("start").alias("_cw_start"), F.col("end").alias("_cw_end"), F.explode(F.concat(*map(bins, range(len(BINS))))).alias("_cw_at"))
    listed = listed.select("contig_id", "_cw_start", "_cw_end", F.col("_cw_at.level").alias("_cw_level"), F.col("_cw_at.bin").alias("_cw_bin"))
    level = F.when(F.col("_cw_len") < BINS[0], 0).when(F.col("_cw_len") < BINS[1], 1).otherwise(2)
    width = F.element_at(F.array(*map(size, range(len(BINS)))), level + 1)
    rows = reads.withColumn("_cw_len", read_length).withColumns({"_cw_own": level, "_cw_from": F.floor(F.col("pos") / width)})
    same = (F.col("ref_id") == F.col("contig_id")) & (F.col("_cw_own") == F.col("_cw_level")) & (F.col("_cw_from") == F.col("_cw_bin"))
    meets = (F.col("pos") + F.col("_cw_len") >= F.col("_cw_start")) & (F.col("pos") <= F.col("_cw_end"))
    return rows.join(listed, same & meets, "left_semi").drop("_cw_len", "_cw_own", "_cw_from")


def drop_reasons(min_mapq: int = 40, check_flags: bool = True) -> dict[str, Column]:
    """Why an alignment is dropped, as conditions of which at most one holds: the first in this order."""
    each = {
        "unknown_contig": F.col("ref_id").isNull() | F.col("next_ref_id").isNull(),
        "same_contig": F.col("ref_id") == F.col("next_ref_id"),
        "mapping_quality": ~quality_ok(min_mapq),
    } | ({"flags": ~flags_ok()} if check_flags else {})
    out, before = {}, F.lit(False)
    for name, holds in each.items():
        holds = F.coalesce(holds, F.lit(True))
        out[name], before = holds & ~before, before | holds
    return out


def _near_sites(rows: DataFrame, windows: DataFrame | None, read_length: Column, label: str, watch: Watch | None) -> DataFrame:
    if windows is not None:
        rows = in_windows(rows, windows, read_length)
    return rows if watch is None else watch(rows, f"{label} kept")


def filter_alignments(alignments: DataFrame, windows: DataFrame | None = None, min_mapq: int = 40, check_flags: bool = True, watch: Watch | None = None, label: str = "alignments") -> DataFrame:
    """Read pairs of the alignments that are known, good, between two contigs and, with ``windows``, near a site; ``watch`` counts them all, by the reason they go, and those kept."""
    rows = alignments if watch is None else watch(alignments, label, **drop_reasons(min_mapq, check_flags))
    keep = quality_ok(min_mapq) & F.col("ref_id").isNotNull() & F.col("next_ref_id").isNotNull() & (F.col("ref_id") != F.col("next_ref_id"))
    rows = rows.filter(keep & flags_ok() if check_flags else keep)
    return _near_sites(rows, windows, F.col("l_seq"), label, watch).select("ref_id", "pos", "next_ref_id", "next_pos")


def filter_pairs(pairs: DataFrame, windows: DataFrame | None = None, read_length: int = 150, watch: Watch | None = None, label: str = "pairs") -> DataFrame:
    """Read pairs between two contigs and, with ``windows``, near a site; ``watch`` counts them all, those within a contig, and those kept."""
    rows = pairs if watch is None else watch(pairs, label, same_contig=F.col("ref_id") == F.col("next_ref_id"))
    return _near_sites(rows.filter(F.col("ref_id") != F.col("next_ref_id")), windows, F.lit(read_length), label, watch)


def bind_names(pairs: DataFrame, contigs: DataFrame) -> DataFrame:
    """Pairs by contig name (name, pos, next_name, next_pos) as pairs by contig id; unknown names go.

    A name met twice means its first contig. The size of the contig table decides how it is joined.
    """
    ids = contigs.groupBy("name").agg(F.min("contig_id").alias("id"))
    first = ids.select(F.col("name"), F.col("id").alias("ref_id"))
    second = ids.select(F.col("name").alias("next_name"), F.col("id").alias("next_ref_id"))
    return pairs.join(first, "name").join(second, "next_name").select("ref_id", "pos", "next_ref_id", "next_pos")


def bind_references(alignments: DataFrame, references: DataFrame, contigs: DataFrame) -> DataFrame:
    """Alignments by the file's own reference numbers as alignments by contig id, null where the name is unknown.

    Files, which are few, are numbered, so that alignments go through the joins by numbers and not by their files' paths.
    """
    ids = contigs.groupBy("name").agg(F.min("contig_id").alias("id"))
    files = F.broadcast(references.select("file").distinct().select("file", F.row_number().over(Window.orderBy("file")).alias("_cw_file")))
    known = references.join(files, "file").join(ids, "name").select("_cw_file", "ref_no", "id")
    one = known.select("_cw_file", "ref_no", F.col("id").alias("ref_id"))
    two = known.select("_cw_file", F.col("ref_no").alias("next_ref_no"), F.col("id").alias("next_ref_id"))
    rows = alignments.join(files, "file", "left").join(one, ["_cw_file", "ref_no"], "left").join(two, ["_cw_file", "next_ref_no"], "left")
    return rows.drop("_cw_file")
