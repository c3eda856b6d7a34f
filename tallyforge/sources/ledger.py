"""What became of every batch: one appended row per event, and the state that follows from the newest ones.

A batch is written under an attempt's name, and exists for readers only once a `landed` row names that attempt. Of
several attempts at one batch the one recorded last counts, so that a repeated ingest replaces the earlier one, and one
that died leaves nothing to see. `loaded` and `failed` rows tell what the next layer made of an attempt.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.sources.versions import one_row, path_exists

LANDED, LOADED, FAILED = "landed", "loaded", "failed"
SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("attempt", T.StringType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("n", T.LongType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("recorded_at", T.TimestampType(), False),
    ]
)


@dataclass(frozen=True)
class Batch:
    """A batch as its newest attempt left it."""

    batch_id: str
    attempt: str
    state: str
    n: int
    ingested_at: datetime

    @property
    def folder(self) -> str:
        return f"batch_id={self.batch_id}/attempt={self.attempt}"


class Ledger:
    """The ledger beside the batches below `path`. Reading it touches no batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/_ledger"

    def events(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def record(self, batch_id: str, attempt: str, state: str, n: int, ingested_at: datetime) -> None:
        """Append one event; it becomes visible at once or not at all."""
        values = [F.lit(v).cast(f.dataType) for v, f in zip((batch_id, attempt, state, n, ingested_at), SCHEMA)]
        one_row(self.spark, SCHEMA, [*values, F.current_timestamp()]).write.mode("append").parquet(self.path)

    def mark(self, batches: Sequence[Batch], state: str) -> None:
        """The given attempts are now `state`, all of them in one appended file."""
        if batches:
            rows = [(b.batch_id, b.attempt, state, b.n, b.ingested_at) for b in batches]
            frame = self.spark.createDataFrame(rows, T.StructType(SCHEMA.fields[:-1])).coalesce(1)
            frame.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(self.path)

    def states(self) -> DataFrame:
        """One row per batch: its newest landed attempt, and the newest state of that."""
        per_attempt = self.events().groupBy("batch_id", "attempt").agg(
            F.max(F.when(F.col("state") == LANDED, F.col("recorded_at"))).alias("landed_at"),
            F.max_by("state", F.struct("recorded_at", F.col("state") != LANDED, F.col("state"))).alias("state"),
            F.max_by("n", F.col("state") == LANDED).alias("n"),
            F.max("ingested_at").alias("ingested_at"),
        )
        newest = F.max_by(F.struct("attempt", "state", "n", "ingested_at"), F.struct("landed_at", "attempt")).alias("newest")
        return per_attempt.filter("landed_at is not null").groupBy("batch_id").agg(newest).select("batch_id", "newest.*")

    def batches(self) -> list[Batch]:
        """Every batch in the order of ingestion, equal times by id: one small row each."""
        return [Batch(*row) for row in self.states().select("batch_id", "attempt", "state", "n", "ingested_at").orderBy("ingested_at", "batch_id").collect()]


def newest(batches: Sequence[Batch]) -> Batch | None:
    return batches[-1] if batches else None


def backlog(batches: Sequence[Batch]) -> list[Batch]:
    """Batches that landed and were neither loaded nor failed, oldest first."""
    return [b for b in batches if b.state == LANDED]


def high_water(batches: Sequence[Batch]) -> datetime | None:
    """The time up to which no batch waits: that of the last one before the first that is open."""
    done = None
    for batch in batches:
        if batch.state == LANDED:
            break
        done = batch.ingested_at
    return done
