"""Ingest newly landed record files as they come: each file once, across restarts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources import bronze


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    progress: str,
    source_url: str,
    batch_prefix: str = "stream_",
    run_ts: datetime | None = None,
) -> int:
    """Append every file that landed since the last call as raw batches, then stop; returns the rows added.

    `progress` is the query's checkpoint folder on shared storage. A micro-batch always has the same batch id, so one
    that is repeated after a failure replaces itself; the next run of the silver stage loads all that are open.
    Records are one JSON object per line.
    """
    added = []

    def write(records: DataFrame, epoch: int) -> None:
        at = run_ts or datetime.now(timezone.utc)
        added.append(bronze.append(records, bronze_path, source_url, f"{batch_prefix}{epoch:010d}", at))

    texts = spark.readStream.text(landing).select(F.col("value").alias("raw_data")).filter(F.trim("raw_data") != "")
    started = texts.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()
    started.awaitTermination()
    return sum(added)
