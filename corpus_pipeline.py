"""A training corpus from raw documents: five stages, each a table written and read again.

Every stage but the last returns the columns of its input, whatever other columns that
has: columns an operator would replace are set aside and put back. Stages pass on null
texts as rows without words, repeated rows as separate rows, and empty tables as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactweave.llm import mixing, packing, quality, simhash, suffix_dedup
from contactweave.llm.common import stored, table

#: Near-duplicates: Jaccard similarity of the sets of word shingles of this length, as a fraction.
WORDS, LEAST = 5, (4, 5)

#: No SQL: suffix dedup and the fingerprints' hash are beyond it; the tests hold the stages against brute force.
ORACLE_SQL = None


def _aside(docs: DataFrame, *needed: str) -> DataFrame:
    rest = [F.col(c) for c in docs.columns if c not in needed]
    return docs.select(*needed, (F.struct(*rest) if rest else F.lit(None)).alias("_cw_rest"))


def _back(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    own = {c for c in rows.columns if not c.startswith("_cw_")}
    rest = rows.schema["_cw_rest"].dataType
    inside = set(rest.names) if hasattr(rest, "names") else set()
    return rows.select(*[(changed[c] if c in changed else F.col("_cw_rest")[c] if c in inside else F.col(c)).alias(c) for c in docs.columns if c in inside or c in own or c in changed])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy rejects."""
    return _back(quality.ledger(_aside(docs, "text")).filter(quality.passes("prose-1")), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id."""
    return simhash.keep_one(docs, words=WORDS, least=LEAST)


def suffix_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur twice; ``n_chars`` is counted again."""
    out = suffix_dedup.remove_repeats(_aside(docs, "text"), as_text=True)
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    changed = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return _back(out, docs, **changed)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return _back(mixing.emit(mixing.mix(_aside(docs, "doc_id", "text", "source"))), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in the sequences."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_removal),
    ("source_mixing", source_mix),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
