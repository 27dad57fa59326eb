"""Text output: scaffold FASTA, AGP, and tab-separated dumps of every table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactweave.functions.storage import stored
from contactweave.operators.running import ranked

AGP_COLUMNS = ["object", "object_beg", "object_end", "part_number", "component_type", "component_id", "component_beg", "component_end", "orientation"]


def write_fasta(pieces: DataFrame, path: str, tasks: int | None = None) -> None:
    """Records of (object, ord, part, seq): a header line, then a line a piece, written by ranges of (object, ord, part).

    The part files in the order of their names are the whole file; a scaffold may run over several, so no
    task has to write a whole one. ``<path>.files`` has each part file's offset and bytes in the whole,
    ``<path>.objects`` each record's.
    """
    keys = ["object", "ord", "part"]
    heads = pieces.groupBy("object").agg(F.min(F.struct("ord", "part")).alias("x")).select("object", "x.ord", (F.col("x.part") - 1).alias("part"), F.concat(F.lit(">"), "object").alias("value"))
    lines = stored(heads.unionByName(pieces.select(*keys, F.col("seq").alias("value"))), "lines")
    dealt = lines.repartitionByRange(tasks, *keys) if tasks else lines.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).select("value").write.text(path)
    files = lines.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("length").alias("bytes"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files.select("file", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"), "bytes").write.option("sep", "\t").csv(f"{path}.files")
    records = lines.groupBy("object").agg(F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"))
    ranked(records, [F.col("object")], "bytes").select("object", (F.col("running") - F.col("bytes")).alias("offset"), "bytes").write.option("sep", "\t").csv(f"{path}.objects")


def write_agp(rows: DataFrame, path: str) -> None:
    rows.select(*AGP_COLUMNS).sortWithinPartitions("object", "part_number").write.option("sep", "\t").csv(path)


def _named(rows: DataFrame, contigs: DataFrame, key: str, name: str) -> DataFrame:
    return rows.join(contigs.select(F.col("contig_id").alias(key), F.col("name").alias(name)), key)


def dump_nodes(contigs: DataFrame) -> DataFrame:
    return contigs.select("contig_id", "name", "re_count", "length")


def dump_edges(edges: DataFrame, contigs: DataFrame) -> DataFrame:
    return _named(_named(edges, contigs, "start", "start_name"), contigs, "end", "end_name").select("start_name", "end_name", "pairs", "weight")


def dump_reads(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    return _named(_named(reads, contigs, "ref_id", "name"), contigs, "next_ref_id", "next_name").select("name", "pos", "next_name", "next_pos")


def dump_group(members: DataFrame, contigs: DataFrame) -> DataFrame:
    return members.join(contigs, "contig_id").select("group_id", "contig_id", "name", "length")


def dump_chromosomes(chromosomes: DataFrame, contigs: DataFrame) -> DataFrame:
    sign = F.when(F.col("reversed"), "-").otherwise("+")
    return chromosomes.join(contigs, "contig_id").select("group_id", "ord", "name", "length", sign.alias("direction"))


def dump_alleles(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    each = rows.select("row_id", F.posexplode("contig_ids").alias("k", "contig_id"))
    named = _named(each, contigs, "contig_id", "name").groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("k", "name"))).alias("x"))
    return named.select("row_id", F.array_join("x.name", "\t").alias("names"))


def dump_alignments(alignments: DataFrame, contigs: DataFrame) -> DataFrame:
    named = _named(_named(alignments, contigs, "ref_id", "name"), contigs, "next_ref_id", "next_name")
    return named.select("name", "pos", "mapq", "flag", "l_seq", "next_name", "next_pos")


DUMPS = {"nodes": dump_nodes, "edges": dump_edges, "reads": dump_reads, "group": dump_group, "chromosomes": dump_chromosomes, "alleles": dump_alleles, "alignments": dump_alignments}


def write_tsv(rows: DataFrame, path: str) -> None:
    rows.write.option("sep", "\t").option("header", True).csv(path)
