"""Contact counts kept up to date while read pairs arrive: an extension, as counting links is a plain sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from contactweave.operators.links import link_counts

READS = "ref_id int, pos int, next_ref_id int, next_pos int"


def count_stream(spark: SparkSession, folder: str, files_a_trigger: int = 100) -> DataFrame:
    """Streaming (lo, hi, pairs) over Parquet files of read pairs that land in ``folder``."""
    reads = spark.readStream.schema(READS).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)
    return link_counts(reads)


def write_counts(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch's changed counts, as Parquet below ``out`` by batch; a batch written again replaces itself."""

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
