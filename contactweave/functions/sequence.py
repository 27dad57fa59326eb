"""Column functions over nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_nucleotides(seq: Column) -> Column:
    """Only A, C, G, T, U, in upper case."""
    return seq.rlike("^[ACGTU]*$")


def reverse_complement(seq: Column) -> Column:
    """Bases complemented in either case and reversed; any other letter stays."""
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def record_name(header: Column) -> Column:
    """The part of a record's header before the first white space."""
    return F.regexp_extract(header, r"^(\S*)", 1)


def to_int(text: Column) -> Column:
    """Integer at the start of the text, 0 if there is none."""
    return F.coalesce(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1).try_cast("int"), F.lit(0))


def motif_count(seq: Column, motifs: list[str]) -> Column:
    """Hits of all motifs; those of one motif don't overlap."""
    total: Column = F.lit(0)
    for motif in motifs:
        total = total + F.regexp_count(seq, F.lit(motif))
    return total.cast("int")
