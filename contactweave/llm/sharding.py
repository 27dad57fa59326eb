"""Sharding by weighted rendezvous hashing.

Every shard draws a uniform number from the hash of (shard, key); the key goes
to the shard with the largest ``weight / -ln(u)``. A shard's draws do not depend
on the other shards, so a new shard only takes rows into itself, and a removed
one only gives its own away; each holds a share proportional to its weight.

Defined cases: a null key is a key like any other; a null text has size 1 and
the CRC of the empty string; equal keys always share a shard; an empty table
gives an empty table; repeated rows get different slots of the same shard.
Columns ``shard``, ``slot`` and ``grown_shard`` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactweave.llm.common import running_total, table, text_crc32

#: Slots are dealt inside sub-buckets of a shard, at least so many, each of about so many rows;
#: tables of up to so many sub-bucket sizes are broadcast.
SLOT_BUCKETS, BUCKET_ROWS, BROADCAST = 1024, 1 << 16, 1 << 17


def rendezvous(key: Column, shards: Sequence[tuple[int, float]]) -> Column:
    """The shard, of (id, weight) pairs, that wins the key."""
    if not shards or any(w <= 0 for _, w in shards) or len({s for s, _ in shards}) < len(shards):
        raise ValueError("shards need distinct ids and positive weights")
    text = F.coalesce(key.cast("string"), F.lit("\0null"))

    def bid(shard: int, weight: float) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(F.lit(f"shard {shard}"), text), 11)
        u = (draw.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((F.lit(float(weight)) / -F.ln(u)).alias("bid"), F.lit(-shard).alias("minus"))

    best = bid(*shards[0]) if len(shards) == 1 else F.greatest(*(bid(*s) for s in shards))
    return (-best["minus"]).cast("int")


def shard_rows(df: DataFrame, key: str, shards: Sequence[tuple[int, float]], grown: Sequence[tuple[int, float]] | None = None, text: str | None = None) -> DataFrame:
    """``df`` with ``shard``, its gapless ``slot`` there, and ``grown_shard``, the shard among ``grown``.

    ``text``: a column that helps to spread the rows of a very common key over the slot buckets.
    The number of these grows with the rows, which are counted first (no column is read for that).
    """
    buckets = max(SLOT_BUCKETS, -(-df.count() // (BUCKET_ROWS * len(shards))))
    spread = [F.col(key).cast("string")] + ([F.col(text)] if text else [])
    out = (
        df.withColumn("shard", rendezvous(F.col(key), shards))
        .withColumn("grown_shard", rendezvous(F.col(key), grown) if grown else F.lit(None).cast("int"))
        .withColumn("_cw_bucket", F.pmod(F.xxhash64(F.lit("slot"), *spread), F.lit(buckets)).cast("int"))
        .withColumn("_cw_one", F.lit(1).cast("long"))
    )
    return running_total(out, ["shard"], "_cw_bucket", spread, "_cw_one", "slot", bounded=len(shards) * buckets <= BROADCAST).drop("_cw_bucket", "_cw_one")


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
    )
    eight = [(i, 1.0) for i in range(8)]
    out = shard_rows(docs, "doc_id", eight, [*eight, (8, 1.0)], text="text_crc32")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard")
