"""Append-only raw table of identified batches, and the run audit table. The ledger beside it says which batches exist."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.sources.ledger import LANDED, Batch, Ledger, newest
from tallyforge.sources.versions import new_run, one_row, remove_path

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("raw_data", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("source_url", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
    ]
)
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_ingested", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType()),
    ]
)
EMPTY = "the raw table is empty; ingest a batch first"
SUCCESS, FAILED = "success", "failed"
NAME = re.compile(r"[A-Za-z0-9_.-]+")


def stamp(records: DataFrame, source_url: str, batch_id: str, run_ts: datetime | None = None) -> DataFrame:
    """Records with the batch columns added; `run_ts` defaults to the time of the query."""
    when = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return records.select(
        "raw_data",
        when.alias("ingested_at"),
        F.lit(source_url).alias("source_url"),
        F.lit(batch_id).alias("batch_id"),
    )


def write_attempt(records: DataFrame, path: str, source_url: str, batch_id: str, run_ts: datetime | None = None) -> Batch:
    """Write one batch under a new attempt's name, counted while writing. No reader sees it until it is committed."""
    if not NAME.fullmatch(batch_id):
        raise ValueError(f"a batch id is made of letters, digits and _ . - only, not {batch_id!r}")
    seen, attempt = Observation(f"append {batch_id}"), new_run()
    times = (F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("at"))
    stamped = stamp(records, source_url, batch_id, run_ts).observe(seen, *times)
    stamped.drop("batch_id").write.parquet(f"{path}/batch_id={batch_id}/attempt={attempt}")
    return Batch(batch_id, attempt, LANDED, seen.get["n"], run_ts or seen.get["at"])


def commit(spark: SparkSession, path: str, batch: Batch) -> None:
    """Make an attempt the batch: from now on readers see it, in place of an earlier attempt at the same batch."""
    Ledger(spark, path).record(batch.batch_id, batch.attempt, LANDED, batch.n, batch.ingested_at)


def append(records: DataFrame, path: str, source_url: str, batch_id: str, run_ts: datetime | None = None) -> int:
    """Add one batch and return its row count. No records make no batch.

    Exactly once: an attempt that dies is never seen, and one that is repeated under the same id replaces the first.
    """
    batch = write_attempt(records, path, source_url, batch_id, run_ts)
    if batch.n:
        commit(records.sparkSession, path, batch)
    else:
        remove_path(records.sparkSession, f"{path}/{batch.folder}")
    return batch.n


def read(spark: SparkSession, path: str, batches: Sequence[Batch] | None = None) -> DataFrame:
    """The committed batches, or the given ones. Only their folders are listed and read."""
    batches = Ledger(spark, path).batches() if batches is None else batches
    if not batches:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    folders = [f"{path}/{b.folder}" for b in batches]
    return spark.read.schema(BRONZE_SCHEMA).option("basePath", path).parquet(*folders).select(*BRONZE_SCHEMA.names)


def newest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the batch ingested last, found in the ledger: one folder is read. Without a batch it raises."""
    last = newest(Ledger(spark, path).batches())
    if last is None:
        raise ValueError(EMPTY)
    return read(spark, path, [last])


def latest_batch_id(bronze: DataFrame) -> DataFrame:
    """One row, `batch_id` of the newest batch; equal times are decided by the greater id. Reads two narrow columns."""
    newest = F.max_by("batch_id", F.struct("ingested_at", "batch_id"))
    return bronze.agg(newest.alias("batch_id"))


def latest_batch(bronze: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Rows of the newest batch, or of the named one.

    The id is a scalar subquery against the partition column, so only that batch's folder is read. An empty
    table raises when the query runs.
    """
    if batch_id is not None:
        return bronze.filter(F.col("batch_id") == batch_id)
    empty = F.raise_error(F.lit(EMPTY))
    newest = latest_batch_id(bronze).select(F.coalesce("batch_id", empty.cast("string")))
    return bronze.filter(F.col("batch_id") == newest.scalar())


def batch_counts(bronze: DataFrame) -> DataFrame:
    """Row count and time range of every batch present."""
    return bronze.groupBy("batch_id", F.col("source_url").alias("source")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ingested_at").alias("first_at"),
        F.max("ingested_at").alias("last_at"),
    )


def audit(bronze: DataFrame, runs: DataFrame) -> DataFrame:
    """Audit rows of runs (batch_id, source, status, error_message, started_at, finished_at) with their counts.

    A failed run has 0 rows, and so has a successful one that received nothing.
    """
    counts = batch_counts(bronze).select("batch_id", "source", "n")
    joined = runs.join(counts, ["batch_id", "source"], "left")
    rows = F.when(F.col("status") == SUCCESS, F.coalesce("n", F.lit(0))).otherwise(0)
    return joined.select(
        "batch_id",
        "source",
        "status",
        rows.cast("bigint").alias("rows_ingested"),
        "error_message",
        "started_at",
        "finished_at",
    )


def log_run(
    spark: SparkSession,
    path: str,
    batch_id: str,
    source: str,
    status: str,
    rows: int,
    error_message: str | None,
    started_at: datetime,
    finished_at: datetime,
) -> None:
    """Append one audit row, in a write of its own."""
    row = (batch_id, source, status, rows, error_message, started_at, finished_at)
    values = [F.lit(value).cast(field.dataType) for value, field in zip(row, AUDIT_SCHEMA)]
    one_row(spark, AUDIT_SCHEMA, values).write.mode("append").parquet(path)
