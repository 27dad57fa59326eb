"""Counts that are taken while rows stream past, without a scan of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Watch:
    """Collects counts of the rows of DataFrames; they are there once a write or another action has run.

    They are figures for a log: a stage that is run again after an executor is lost may be counted again.
    """

    def __init__(self):
        self.seen: list[tuple[str, Observation]] = []

    def __call__(self, df: DataFrame, label: str, **counts: Column) -> DataFrame:
        """``df``, counting its rows as ``rows`` and by each of the conditions."""
        seen = Observation()
        self.seen.append((label, seen))
        return df.observe(seen, F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in counts.items()])

    def take(self) -> list[tuple[str, str, int]]:
        """(label, what, n) since the last call; a label met again adds up."""
        out: dict[tuple[str, str], int] = {}
        taken, self.seen = self.seen, []
        for label, seen in taken:
            for what, n in seen.get.items():
                out[label, what] = out.get((label, what), 0) + n
        return [(label, what, n) for (label, what), n in out.items()]
