"""Restriction motifs: enzyme names, ambiguity codes, argument checks. All tiny and driver-side."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product

# Enzyme names and the motif each cuts at.
ENZYMES = {
    ("ARIMA",): ["GATC", "GAAT", "GACT", "GAGT", "GATT"],
    ("TAQI", "TAQ1"): ["TCGA"],
    ("HAEIII", "HAE3"): ["GGCC"],
    ("DPNI", "DPN1", "DPNII", "DPN2", "MBOI", "MBO1", "SAU3AI"): ["GATC"],
    ("ALUI", "ALU1"): ["AGCT"],
    ("NLAIII", "NLA3", "FAEI", "FAE1", "FATI", "FAT1", "HIN1II", "HSP92II"): ["CATG"],
    ("HPAII", "HPA2"): ["CCGG"],
    ("FOKI", "FOK1"): ["GGATG"],
    ("AAAI", "AAA1"): ["CGGCG"],
    ("HGAI", "HGA1"): ["GACGC"],
    ("BGLII", "BGL2"): ["AGATCT"],
    ("ECORV", "ECOR5"): ["GATATC"],
    ("ECORI", "ECOR1"): ["GAATTC"],
    ("BAMHI", "BAMH1"): ["GGATCC"],
    ("HINDIII", "HIND3"): ["AAGCTT"],
    ("KPNI", "KPN1"): ["GGTACC"],
    ("XBAI", "XBA1"): ["TCTAGA"],
    ("XHOI", "XHO1"): ["CTCGAG"],
    ("SACI", "SAC1"): ["GAGCTC"],
    ("PSTI", "PST1"): ["CTGCAG"],
    ("SMAI", "SMA1"): ["CCCGGG"],
    ("PVUII", "PVU2"): ["CAGCTG"],
    ("SALI", "SAL1"): ["GTCGAC"],
    ("SCAI", "SCA1"): ["AGTACT"],
    ("SPEI", "SPE1"): ["ACTAGT"],
    ("SPHI", "SPH1"): ["GCATGC"],
    ("STUI", "STU1"): ["AGGCCT"],
    ("NDEI", "NDE1"): ["CATATG"],
    ("NOTI", "NOT1"): ["GCGGCCGC"],
}
# The IUPAC codes for more than one nucleotide.
IUPAC = {
    "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}


def expand(motifs: Iterable[str], *, keep_duplicates: bool = False) -> list[str]:
    """Every plain motif that the ambiguity codes stand for, in order; repeats go unless asked for."""
    plain = ["".join(p) for motif in motifs for p in product(*(IUPAC.get(c, c) for c in motif.upper()))]
    for motif in plain:
        if not motif or set(motif) - set("ACGTU"):
            raise ValueError(f"not a nucleotide motif: {motif!r}")
    return plain if keep_duplicates else list(dict.fromkeys(plain))


def motifs_of(enzymes: str | Iterable[str], *, keep_duplicates: bool = False) -> list[str]:
    """Plain motifs of enzyme names or motifs, one or several, in any case."""
    names = {alias: motifs for aliases, motifs in ENZYMES.items() for alias in aliases}
    given = [enzymes] if isinstance(enzymes, str) else list(enzymes)
    return expand((m for e in given for m in names.get(e.strip().upper(), [e.strip()])), keep_duplicates=keep_duplicates)
