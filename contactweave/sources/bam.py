"""BAM through Spark's own file systems: its reference dictionaries and its alignments, and BAM-like files out.

A BAM file is a row of small compressed blocks that all begin with the same 16 bytes.
Spark's text source, with these as the separator of its lines, reads it as a row a block,
from any store and split by byte ranges like any text file. Each split inflates its blocks
and looks for the first place from which whole, plausible records follow each other. What
stands before that place, and what is left after the split's last whole record, are
fragments: a split's rest and the next one's front make the records in between. These are
put together in file order and must come out even, or an error is raised; so a wrong
start never goes unseen. The decoded rows are stored once, as fragments and records are
both read from them.

Defined cases: a header longer than a split goes on in the following ones; a record may
span splits; empty blocks and files without alignments are fine; a file that isn't made of
such blocks, or ends inside a record, is an error.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.functions.storage import stored

COLUMNS = "ref_no int, pos int, mapq short, flag int, l_seq int, next_ref_no int, next_pos int"
DECODED = f"file string, split long, kind int, data binary, {COLUMNS}"
REFERENCES = "file string, ref_no int, name string, length int"
# The first bytes of every block, and the layout of an alignment's first 32 bytes after its size.
MAGIC = bytes([0x1F, 0x8B, 8, 4, 0, 0, 0, 0, 0, 0xFF, 6, 0, 0x42, 0x43, 2, 0])
HEAD = np.dtype([("ref_no", "<i4"), ("pos", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2"), ("l_seq", "<i4"), ("next_ref_no", "<i4"), ("next_pos", "<i4"), ("span", "<i4")])
SIZE = struct.Struct("<i")
#: Kinds of decoded rows: an alignment; a header; a split's bytes before its first record, after its last one, or all of them.
RECORD, HEADER, FRONT, REST, ALL = range(5)
#: Inflated bytes decoded at once; records in a row that make a start.
CHUNK, CHAIN = 4 << 20, 8


def inflate(data: bytes) -> bytes:
    """The content of one block, given without its first 16 bytes."""
    if len(data) < 12 or int.from_bytes(data[:2], "little") + 1 != len(data) + len(MAGIC):
        raise ValueError("not a block of a BAM file")
    return zlib.decompress(data[2:-8], wbits=-15)


def header_end(raw: bytes) -> int | None:
    """Where the alignments begin, None if the header isn't complete."""
    if len(raw) >= 4 and raw[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    if len(raw) < 8:
        return None
    at = 8 + SIZE.unpack_from(raw, 4)[0]
    if len(raw) < at + 4:
        return None
    (n,), at = SIZE.unpack_from(raw, at), at + 4
    for _ in range(n):
        if len(raw) < at + 4:
            return None
        at += 8 + SIZE.unpack_from(raw, at)[0]
    return at if len(raw) >= at else None


def header_references(raw: bytes) -> Iterator[tuple[str, int]]:
    at = 8 + SIZE.unpack_from(raw, 4)[0]
    (n,), at = SIZE.unpack_from(raw, at), at + 4
    for _ in range(n):
        end = at + 4 + SIZE.unpack_from(raw, at)[0]
        yield raw[at + 4 : end - 1].decode(), SIZE.unpack_from(raw, end)[0]
        at = end + 4


def plausible(size: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Which records' sizes and first 32 bytes agree with each other."""
    own = 32 + head["l_name"].astype(np.int64) + 4 * head["n_cigar"].astype(np.int64) + (head["l_seq"].astype(np.int64) + 1) // 2 + head["l_seq"]
    known = (head["ref_no"] >= -1) & (head["next_ref_no"] >= -1) & (head["pos"] >= -1) & (head["next_pos"] >= -1)
    return known & (head["l_name"] >= 1) & (head["l_seq"] >= 0) & (size >= own)


def heads_at(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return raw[starts[:, None] + np.arange(4, 36)].reshape(-1).view(HEAD)


def whole_records(raw: bytes, at: int, most: int | None = None) -> tuple[np.ndarray, int]:
    """Starts of the whole records from ``at`` on, and where the last one ends."""
    out, n, size = [], len(raw), SIZE.unpack_from
    while at + 36 <= n and (most is None or len(out) < most):
        end = at + 4 + size(raw, at)[0]
        if end > n or end < at + 36:
            break
        out.append(at)
        at = end
    return np.array(out, dtype=np.int64), at


def first_record(raw: bytes, complete: bool) -> int | None:
    """The first place from which ``CHAIN`` records follow each other, or fewer up to the end of a ``complete`` split."""
    data = np.frombuffer(raw, dtype=np.uint8)
    for begin in range(0, max(0, len(raw) - 35), 1 << 16):
        places = np.arange(begin, min(begin + (1 << 16), len(raw) - 35))
        size = data[places[:, None] + np.arange(4)].reshape(-1).view("<i4")
        fine = places[(size >= 32) & plausible(size, heads_at(data, places))]
        for at in fine.tolist():
            starts, end = whole_records(raw, at, CHAIN)
            if not len(starts) or len(starts) < CHAIN and not complete:
                continue
            head = heads_at(data, starts)
            name_end = data[starts + 35 + head["l_name"]]
            sizes = data[starts[:, None] + np.arange(4)].reshape(-1).view("<i4")
            if not plausible(sizes, head).all() or name_end.any():
                continue
            if len(starts) == CHAIN or end + 4 > len(raw) or SIZE.unpack_from(raw, end)[0] >= 32:
                return at
    return None


def _rows(file: str, split: int, kind: int, data: bytes | None = None, head: np.ndarray | None = None) -> pa.RecordBatch:
    n = 1 if head is None else len(head)
    names = [x.split() for x in COLUMNS.split(", ")]
    kinds = {"int": pa.int32(), "short": pa.int16()}
    own = [pa.nulls(n, kinds[t]) if head is None else pa.array(head[c].astype("i4" if t == "int" else "i2"), kinds[t]) for c, t in names]
    columns = [*(pa.repeat(pa.scalar(x, t), n) for x, t in ((file, pa.string()), (split, pa.int64()), (kind, pa.int32()), (data, pa.binary()))), *own]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in DECODED.split(", ")])


def decode_split(file: str, split: int, blocks: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """Alignments and fragments of one split, from its blocks in order."""
    raw, started, look = b"", False, CHUNK
    ended = False
    while not ended:
        parts, held = [raw], len(raw)
        while held < look:
            data = next(blocks, None)
            if data is None:
                ended = True
                break
            if data:
                parts.append(inflate(data))
                held += len(parts[-1])
            elif split:
                raise ValueError("not a block of a BAM file")
        raw = b"".join(parts)
        if not started:
            at = header_end(raw) if split == 0 else first_record(raw, ended)
            if at is None:
                look *= 2
                continue
            yield _rows(file, split, FRONT if split else HEADER, raw[:at])
            raw, started = raw[at:], True
        starts, end = whole_records(raw, 0)
        if len(starts):
            yield _rows(file, split, RECORD, None, heads_at(np.frombuffer(raw, dtype=np.uint8), starts))
        raw = raw[end:]
        look = len(raw) + CHUNK
    yield _rows(file, split, REST if started else ALL, raw)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((f.as_py(), s.as_py(), d.as_py()) for batch in batches for f, s, d in zip(*(batch.column(c) for c in ("file", "split", "data")), strict=True))
    for (file, split), own in itertools.groupby(rows, key=lambda r: r[:2]):
        yield from decode_split(file, split, (data for _, _, data in own))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Headers and records that fragments in file order make up; nothing may be left over."""
    for batch in batches:
        for file, parts in zip(batch.column("file").to_pylist(), batch.column("parts").to_pylist(), strict=True):
            raw = b"".join(p["data"] for p in parts)
            if parts[0]["split"] == 0 and parts[0]["kind"] == ALL:
                at = header_end(raw)
                if at is None:
                    raise ValueError(f"{file} ends inside its header")
                yield _rows(file, 0, HEADER, raw[:at])
                raw = raw[at:]
            starts, end = whole_records(raw, 0)
            head = heads_at(np.frombuffer(raw, dtype=np.uint8), starts) if len(starts) else np.empty(0, dtype=HEAD)
            sizes = np.array([SIZE.unpack_from(raw, k)[0] for k in starts.tolist()], dtype=np.int64)
            if end != len(raw) or not plausible(sizes, head).all():
                raise ValueError(f"{file} ends inside a record, or isn't made of whole records")
            if len(starts):
                yield _rows(file, 0, RECORD, None, head)


def decoded(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, kind, data, ...) of all files, headers and alignments whole; stored."""
    text = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    blocks = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("data"))
    rows = stored(blocks.mapInArrow(_decode, DECODED), "decoded")
    # Two rows a split: the fragments of one file are few however large it is.
    fragments = rows.filter(F.col("kind").isin(FRONT, REST, ALL)).select("file", "split", "kind", "data")
    order = Window.partitionBy("file").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = fragments.withColumn("part", F.count_if(F.col("kind") == REST).over(order))
    lists = numbered.groupBy("file", "part").agg(F.sort_array(F.collect_list(F.struct("split", "kind", "data"))).alias("parts")).select("file", "parts")
    return rows.filter(F.col("kind").isin(RECORD, HEADER)).unionByName(stored(lists.mapInArrow(_joined, DECODED), "joined"))


def _references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, raw in zip(batch.column("file"), batch.column("data"), strict=True):
            found = list(header_references(raw.as_py()))
            columns = [pa.array([file.as_py()] * len(found), pa.string()), pa.array(range(len(found)), pa.int32()), pa.array([n for n, _ in found], pa.string()), pa.array([n for _, n in found], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in REFERENCES.split(", ")])


def references(rows: DataFrame) -> DataFrame:
    """(file, ref_no, name, length) of decoded files."""
    return rows.filter(F.col("kind") == HEADER).select("file", "data").mapInArrow(_references, REFERENCES)


def alignments(rows: DataFrame) -> DataFrame:
    """(file, ref_no, pos, mapq, flag, l_seq, next_ref_no, next_pos) of decoded files."""
    return rows.filter(F.col("kind") == RECORD).select("file", *[x.split()[0] for x in COLUMNS.split(", ")])


def block(content: bytes) -> bytes:
    """A block without its first 16 bytes."""
    squeezed = zlib.compressobj(1, wbits=-15)
    data = squeezed.compress(content) + squeezed.flush()
    return struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(content), len(content))


def header_bytes(names: list[tuple[str, int]]) -> bytes:
    return b"BAM\1" + struct.pack("<ii", 0, len(names)) + b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in names)


def record_bytes(head: np.ndarray) -> bytes:
    """Alignments of these heads; sequences and qualities are left blank."""
    front = np.zeros(len(head), dtype=[("size", "<i4"), ("head", HEAD), ("name", "S2")])
    front["head"], front["name"] = head, b"r"
    front["head"]["l_name"] = 2
    blank = (head["l_seq"].astype(np.int64) + 1) // 2 + head["l_seq"]
    n = front.itemsize
    front["size"] = n - 4 + blank
    starts = np.cumsum(n + blank) - (n + blank)
    out = np.full(int((n + blank).sum()), 0xFF, dtype=np.uint8)
    out[starts[:, None] + np.arange(n)] = front.view(np.uint8).reshape(-1, n)
    return out.tobytes()


def blocks_of(pieces: Iterator[bytes], size: int = 60_000) -> Iterator[bytes]:
    """The pieces in blocks of ``size`` bytes; records run across blocks."""
    held = b""
    for piece in pieces:
        held += piece
        full = len(held) - len(held) % size
        for at in range(0, full, size):
            yield block(held[at : at + size])
        held = held[full:]
    yield block(held)


def _numbered(batch: pa.RecordBatch, name: str, length: str, number: dict[str, int], names: list[tuple[str, int]]) -> np.ndarray:
    """The numbers of a batch's contigs; new ones are added to the dictionary."""
    coded = batch.column(name).dictionary_encode()
    places = coded.indices.to_numpy()
    seen, first = np.unique(places, return_index=True)
    for value, size in zip(coded.dictionary.take(pa.array(seen)).to_pylist(), batch.column(length).take(pa.array(first)).to_pylist(), strict=True):
        if value not in number:
            number[value] = len(names)
            names.append((value, size))
    return np.array([number[x] for x in coded.dictionary.to_pylist()], dtype=np.int32)[places]


def write_alignments(rows: DataFrame, path: str, most: int = 20_000) -> None:
    """Files of blocks, one a task, from (name, length, pos, mapq, flag, l_seq, next_name, next_length, next_pos).

    A file's dictionary stands in front of its alignments and has the contigs of these alone, so a contig has another
    number in every file, and a task holds its alignments' heads, 32 bytes each, until it has seen all; ``most`` are
    written out at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        names: list[tuple[str, int]] = []
        heads = []
        for batch in batches:
            head = np.zeros(batch.num_rows, dtype=HEAD)
            head["ref_no"] = _numbered(batch, "name", "length", number, names)
            head["next_ref_no"] = _numbered(batch, "next_name", "next_length", number, names)
            for column in ("pos", "mapq", "flag", "l_seq", "next_pos"):
                head[column] = batch.column(column).to_numpy()
            heads.append(head)
        if not names:
            return
        records = (record_bytes(head[at : at + most]) for head in heads for at in range(0, len(head), most))
        for data in itertools.chain([b""], blocks_of(itertools.chain([header_bytes(names)], records))):
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

    out = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    out.write.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
