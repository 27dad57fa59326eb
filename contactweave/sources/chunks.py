"""Contigs as rows of chunks, so that none has to fit a row.

A chunk is (contig_id, chunk, start, own, seq): its own bases from ``start`` on, and behind
them a few bases of the next chunk, so that what begins in a chunk can be seen whole in it.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.functions.storage import stored
from contactweave.operators.running import ranked

#: Bases of a chunk, and of the next one behind them: longer than any motif.
CHUNK, OVERLAP = 1 << 20, 64
NAME, BLANKS = re.compile(r"\S*", re.ASCII), re.compile(r"\s+", re.ASCII)
PIECES = "file string, split long, record int, name string, at long, bases string"


def chunked(sequences: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of whole sequences (contig_id, seq); an empty one has one empty chunk."""
    count = F.greatest(F.lit(0), F.floor((F.length("seq") - 1) / chunk)).cast("int")
    rows = sequences.select("contig_id", "seq", F.explode(F.sequence(F.lit(0), count)).alias("chunk"))
    start = F.col("chunk").cast("long") * chunk
    rows = rows.select("contig_id", "chunk", start.alias("start"), F.least(F.lit(chunk), F.length("seq") - start).cast("int").alias("own"), F.substring("seq", (start + 1).cast("int"), F.lit(chunk + overlap)).alias("seq"))
    return rows


def own_bases(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``seq`` cut to their own bases."""
    return chunks.withColumn("seq", F.substring("seq", F.lit(1), F.col("own")))


def lengths(chunks: DataFrame) -> DataFrame:
    """(contig_id, length), length as a long."""
    return chunks.groupBy("contig_id").agg(F.sum(F.col("own").cast("long")).alias("length"))


def _pieces(most: int):
    """Headers and pieces of up to ``most`` bases of a split's lines; ``record`` counts the split's headers so far, ``at`` the bases behind the last one."""
    names = [x.split()[0] for x in PIECES.split(", ")]
    types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string())

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

    def of_split(file: str, split: int, lines: Iterator[str]) -> Iterator[pa.RecordBatch]:
        record, at, parts, held = 0, 0, [], 0

        def piece() -> tuple:
            return (file, split, record, None, at, "".join(parts))

        for n, line in enumerate(lines):
            # A file's first line is a header with or without its mark.
            if line.startswith(">") or n == split == 0:
                if held:
                    yield rows([piece()])
                record, at, parts, held = record + 1, 0, [], 0
                yield rows([(file, split, record, NAME.match(line.removeprefix(">"))[0], 0, "")])
                continue
            line = BLANKS.sub("", line)
            for begin in range(0, len(line), most):
                parts.append(line[begin : begin + most])
                held += len(parts[-1])
                if held >= most:
                    yield rows([piece()])
                    at, parts, held = at + held, [], 0
        if held:
            yield rows([piece()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "value")), strict=True))
        for (file, split), own in itertools.groupby(lines, key=lambda r: r[:2]):
            yield from of_split(file, split, (value for _, _, value in own))

    return run


def read_fasta_chunks(spark: SparkSession, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(contig_id, name, chunk, start, own, seq) of FASTA files, stored; ids from 0 in file order, records without a sequence dropped.

    A line has to fit a row, a contig doesn't. Splits are read at once; how many records lie in front of
    a split, and how much of the record that goes on in it, follow from one row a split. Bases are
    shuffled once, to their chunks.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    pieces = stored(text.mapInArrow(_pieces(chunk), PIECES), "pieces")
    # One row a split: records begun in it, and bases behind the last beginning.
    ends = pieces.groupBy("file", "split", "record").agg(F.sum(F.length("bases").cast("long")).alias("n"))
    ends = ends.groupBy("file", "split").agg(F.max("record").alias("records"), F.max_by("n", "record").alias("tail"))
    order = Window.orderBy("file", "split")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({"first": F.coalesce(F.sum("records").over(before), F.lit(0)), "open": F.count_if(F.col("records") > 0).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    ends = ends.withColumn("so_far", F.sum("tail").over(Window.partitionBy("open").orderBy("file", "split").rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.select("file", "split", "first", F.coalesce(F.lag("so_far").over(order), F.lit(0)).alias("carried"))
    placed = pieces.join(ends, ["file", "split"]).select((F.col("first") + F.col("record")).alias("of"), "name", (F.col("at") + F.when(F.col("record") == 0, F.col("carried")).otherwise(0)).alias("at"), "bases")
    records = placed.groupBy("of").agg(F.max("name").alias("name"), F.sum(F.length("bases").cast("long")).alias("length")).filter("length > 0")
    contigs = ranked(records, [F.col("of")], "length").select("of", (F.col("n") - 1).alias("contig_id"), "name", "length")
    # Every chunk takes the part of a piece that lies in its own bases or behind them.
    low, high = F.greatest(F.lit(0), F.floor((F.col("at") - overlap) / chunk)), F.floor((F.col("at") + F.length("bases") - 1) / chunk)
    parts = placed.filter("bases <> ''").select("of", "at", "bases", F.explode(F.sequence(low, high)).alias("chunk"))
    begin = F.greatest(F.col("at"), F.col("chunk") * chunk)
    end = F.least(F.col("at") + F.length("bases"), F.col("chunk") * chunk + chunk + overlap)
    parts = parts.select("of", "chunk", begin.alias("begin"), F.substring("bases", (begin - F.col("at") + 1).cast("int"), (end - begin).cast("int")).alias("part")).filter("part <> ''")
    whole = parts.groupBy("of", "chunk").agg(F.array_sort(F.collect_list(F.struct("begin", "part"))).alias("parts"))
    start = F.col("chunk") * chunk
    rows = whole.join(contigs, "of").select("contig_id", "name", F.col("chunk").cast("int").alias("chunk"), start.alias("start"), F.least(F.lit(chunk), F.col("length") - start).cast("int").alias("own"), F.array_join("parts.part", "").alias("seq"))
    return stored(rows, "chunks")
