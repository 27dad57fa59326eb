"""Stage parameters with their defaults, checked when made."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ExtractConfig:
    motifs: tuple[str, ...]
    weight_motifs: tuple[str, ...] = ()
    min_mapq: int = 40
    window: int = 1000
    check_flags: bool = True
    check_windows: bool = True
    pairs_read_length: int = 150
    #: Search texts as they are, so that motifs in lower case aren't found.
    case_compat: bool = False
    #: Count a motif again for each time the ambiguity codes yield it.
    keep_duplicates: bool = False

    def __post_init__(self):
        if not self.motifs or self.window < 0 or not 0 <= self.min_mapq <= 255:
            raise ValueError("motifs are needed, a window of 0 or more and a mapping quality from 0 to 255")


@dataclass(frozen=True)
class DraftConfig:
    min_links: int = 3
    min_re: int = 10
    max_density: float = 2.0


@dataclass(frozen=True)
class PartitionConfig:
    groups: int
    non_informative_ratio: float = 3.0

    def __post_init__(self):
        if self.groups < 1:
            raise ValueError("one group or more")


@dataclass(frozen=True)
class OrderingConfig:
    seed: int = 806
    mutapb: float = 0.2
    ngen: int = 5000
    max_gen: int = 1_000_000
    npop: int = 100
    shuffle_population: bool = False


@dataclass(frozen=True)
class BuildConfig:
    #: Ns written between contigs; the AGP declares 100-base gaps in any case.
    fasta_gap: int = 0
