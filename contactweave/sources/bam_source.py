"""``spark.read.format("bam")``: alignments with contig names, as a data source with partitions and pushed filters.

A partition is a range of a file's bytes and has the records of the blocks that begin in it.
It reads the dictionary at the file's start, looks for the first place from which whole,
plausible records follow each other, and reads on behind its range until its last record is
whole. Filters on ``mapq`` and ``flag`` that compare with a number are applied to the heads of
the records, before rows are made.

Tasks open the files themselves, through pyarrow's file systems (local, HDFS, S3, GCS). Stores
that only Spark reaches are read by ``bam.decoded``, which also holds the records of neighbouring
splits against each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from contactweave.sources.bam import MAGIC, first_record, header_end, header_references, heads_at, inflate, whole_records

SCHEMA = "file string, name string, pos int, mapq short, flag int, l_seq int, next_name string, next_pos int"
#: Bytes of a partition, and bytes read at once.
RANGE, READ = 32 << 20, 4 << 20
COMPARE = {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal}
PUSHED, NEVER_NULL = ("mapq", "flag"), ("file", "pos", "mapq", "flag", "l_seq", "next_pos")


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int


def _files(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    system, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else sorted((f for f in system.get_file_info(fs.FileSelector(place)) if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
    return system, found


def _blocks(file: pa.NativeFile, begin: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the blocks from the first one that begins at ``begin`` or behind it."""
    file.seek(begin)
    # ``held`` begins at the file's place ``at``; what stands in front of ``pos`` is done.
    at, held, pos, more = begin, b"", 0, True
    while True:
        first = held.find(MAGIC, pos)
        head = first + len(MAGIC)
        stop = first + int.from_bytes(held[head : head + 2], "little") + 1
        if first < 0 or len(held) < max(stop, head + 2) + len(MAGIC):
            if more:
                new = file.read(READ)
                at, held, pos, more = at + pos, held[pos:] + new, 0, bool(new)
                continue
            if first < 0 or len(held) < max(stop, head + 2):
                return
        if begin == 0 and at + pos == 0 and first:
            raise ValueError("not a block of a BAM file")
        # The mark may stand in compressed data by chance: behind a block is another, or nothing.
        if held[stop : stop + len(MAGIC)] in (b"", MAGIC):
            yield at + first, inflate(held[head:stop])
            pos = stop
        else:
            pos = first + 1


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.range = options["path"], int(options.get("range", RANGE))
        self.filters: list[tuple[str, type, int]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of PUSHED with a number; the others are Spark's."""
        for f in filters:
            if isinstance(f, IsNotNull) and f.attribute in [(c,) for c in NEVER_NULL]:
                continue
            if type(f) in COMPARE and f.attribute in [(c,) for c in PUSHED] and isinstance(f.value, int):
                self.filters.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Range]:
        _, files = _files(self.path)
        return [Range(f.path, at, min(at + self.range, f.size)) for f in files for at in range(0, f.size, self.range)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system = _files(self.path)[0]
        with system.open_input_file(partition.path) as file:
            raw, blocks = b"", _blocks(file, 0)
            while (start := header_end(raw)) is None:
                place, content = next(blocks, (None, b""))
                if place is None:
                    raise ValueError(f"{partition.path} ends inside its header")
                raw += content
            names = np.array([n for n, _ in header_references(raw[:start])] + [None], dtype=object)
            yield from self._records(partition, file, start, names)

    def _records(self, partition: Range, file: pa.NativeFile, start: int, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The records that begin in the blocks of the range; ``own`` bytes of ``raw`` are from these."""
        raw, own, found, ended = b"", 0, partition.begin == 0, False
        skip = start if found else 0
        blocks = _blocks(file, partition.begin)
        while not ended:
            look = len(raw) + READ
            while len(raw) < look and not ended:
                place, content = next(blocks, (None, b""))
                ended = place is None
                raw += content
                if place is not None and place >= partition.end:
                    break
                own += len(content)
            if skip:
                cut = min(skip, len(raw))
                raw, own, skip = raw[cut:], max(0, own - cut), skip - cut
                if skip:
                    continue
            if not found:
                at = first_record(raw, ended)
                if at is None:
                    continue
                raw, own, found = raw[at:], max(0, own - at), True
            starts, _ = whole_records(raw, 0)
            starts = starts[starts < own]
            if len(starts):
                yield self._rows(partition.path, heads_at(np.frombuffer(raw, dtype=np.uint8), starts), names)
                end = int(starts[-1]) + 4 + int.from_bytes(raw[starts[-1] : starts[-1] + 4], "little")
                raw, own = raw[end:], max(0, own - end)
            if not own and place is not None and place >= partition.end:
                return
        if found and own:
            raise ValueError(f"{partition.path} ends inside a record")

    def _rows(self, file: str, head: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
        for column, kind, value in self.filters:
            head = head[COMPARE[kind](head[column].astype(np.int64), value)]
        number = lambda c: names[head[c]]  # noqa: E731 - the last name, of number -1, is null
        columns = [(np.full(len(head), file, dtype=object), pa.string()), (number("ref_no"), pa.string()), (head["pos"].copy(), pa.int32()), (head["mapq"].astype(np.int16), pa.int16())]
        columns += [(head["flag"].astype(np.int32), pa.int32()), (head["l_seq"].copy(), pa.int32()), (number("next_ref_no"), pa.string()), (head["next_pos"].copy(), pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let Spark push filters down to sources written in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)


__all__ = ["BamSource", "register"]
