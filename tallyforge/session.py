"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CLUSTER_CONF = {
    "spark.sql.ansi.enabled": "true",  # numbers that do not fit raise instead of wrapping around
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str, shuffle_partitions: int | None = None, master: str | None = None) -> SparkSession:
    """A session with adaptive execution on.

    `shuffle_partitions` is the starting count; adaptive execution merges small ones, so give
    roughly (shuffled bytes / 256 MB) on a cluster and the core count locally.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run below the shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="tallyforge-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
