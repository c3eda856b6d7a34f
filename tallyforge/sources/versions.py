"""Tables whose partitions are replaced by writing new folders and then naming them in one appended row.

A partition lives in `<root>/<table>/<partition columns>/run=<id>`, with as many partition columns as its layout names.
Readers see only the folders named by the
newest row of `<root>/_published`, so a run that dies halfway changes nothing, and the rows of a publication
become visible together.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("published_at", T.TimestampType(), False),
        T.StructField("folders", T.MapType(T.StringType(), T.ArrayType(T.StringType())), False),
    ]
)


#: The entry of a publication that holds the fingerprint of every table.
LAYOUTS = "_layouts"


@dataclass(frozen=True)
class Layout:
    """Name, columns, partition columns and key of one table."""

    name: str
    schema: T.StructType
    partitions: tuple[str, ...]
    keys: tuple[str, ...] = ()

    def folder(self, values: Sequence) -> str:
        """A partition's folder, without the run."""
        return "/".join(f"{c}={v}" for c, v in zip(self.partitions, values, strict=True))

    def values(self, folder: str) -> tuple[str, ...]:
        """A folder's partition values, as texts."""
        return tuple(part.split("=", 1)[1] for part in partition_of(folder).split("/"))

    @property
    def fingerprint(self) -> str:
        """Changes with the key, the partition columns, and the names and types of columns."""
        described = [list(self.keys), list(self.partitions), [[f.name, f.dataType.simpleString()] for f in self.schema]]
        return hashlib.sha256(json.dumps(described).encode()).hexdigest()[:16]


class TableSet:
    """The published tables below one shared folder. One writer at a time, as with the daily run it serves.

    The newest publication is read once and then known to this object, its own publications included.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: tuple[int, dict[str, list[str]]] | None = None

    def published(self) -> tuple[int, dict[str, list[str]]]:
        """Newest version number and its folders by table; (0, {}) before the first publication."""
        if self._known is None:
            self._known = self._newest()
        return self._known[0], dict(self._known[1])

    def _newest(self) -> tuple[int, dict[str, list[str]]]:
        path = f"{self.root}/_published"
        if not path_exists(self.spark, path):
            return 0, {}
        log = self.spark.read.schema(PUBLISHED_SCHEMA).parquet(path)
        newest = log.orderBy(F.desc("version")).first()
        return (newest.version, dict(newest.folders)) if newest else (0, {})

    def folders(self, name: str) -> dict[str, str]:
        """Published folders of a table by partition."""
        return by_partition(self.published()[1].get(name, []))

    def changed(self, layouts: Sequence[Layout]) -> set[str]:
        """Names of the tables that were published with another key, other partitions or other columns."""
        folders = self.published()[1]
        marks = dict(entry.split("=") for entry in folders.get(LAYOUTS, []))
        return {layout.name for layout in layouts if folders.get(layout.name) and marks.get(layout.name) != layout.fingerprint}

    def read(self, layout: Layout, folders: list[str] | None = None) -> DataFrame:
        """The published table, or the given folders of it. Only folders are listed, not the whole table."""
        if folders is None:
            folders = self.published()[1].get(layout.name, [])
        if not folders:
            return self.spark.createDataFrame([], layout.schema)
        base = f"{self.root}/{layout.name}"
        stored = T.StructType([*layout.schema.fields, T.StructField("run", T.StringType())])
        paths = [f"{base}/{folder}" for folder in folders]
        rows = self.spark.read.schema(stored).option("basePath", base).parquet(*paths)
        return rows.select(*layout.schema.names)

    def write(self, layout: Layout, rows: DataFrame, values: Sequence[Sequence], run: str) -> list[str]:
        """Write the rows as new folders, one per tuple of partition values, and return the folder names.

        The rebalance hint lets adaptive execution split a large partition over many tasks and merge small ones.
        """
        placed = rows.select(*layout.schema.names).hint("rebalance", *[F.col(c) for c in layout.partitions])
        stored = placed.withColumn("run", F.lit(run))
        stored.write.mode("append").partitionBy(*layout.partitions, "run").parquet(f"{self.root}/{layout.name}")
        return [f"{layout.folder(v)}/run={run}" for v in values]

    def publish(
        self,
        changes: dict[str, list[str]],
        at: datetime,
        notes: dict[str, list[str]] | None = None,
        layouts: Sequence[Layout] = (),
        afresh: Sequence[str] = (),
    ) -> int:
        """Make new folders current, each in place of the earlier folder of its partition.

        Tables named in `afresh` keep none of their earlier folders. The fingerprints of `layouts` and the lists of
        `notes` are stored in the same row, each in place of its earlier content.
        """
        version, folders = self.published()
        for name, added in changes.items():
            kept = {} if name in afresh else by_partition(folders.get(name, []))
            folders[name] = sorted({**kept, **by_partition(added)}.values())
        marks = dict(entry.split("=") for entry in folders.get(LAYOUTS, [])) | {x.name: x.fingerprint for x in layouts}
        folders |= {LAYOUTS: [f"{name}={mark}" for name, mark in sorted(marks.items())], **(notes or {})}
        named = F.from_json(F.lit(json.dumps(folders)), "map<string, array<string>>")
        row = [F.lit(version + 1).cast("bigint"), F.lit(at).cast("timestamp"), named]
        one_row(self.spark, PUBLISHED_SCHEMA, row).write.mode("append").parquet(f"{self.root}/_published")
        self._known = version + 1, folders
        return version + 1

    def expire(self, keep: int = 3) -> list[str]:
        """Delete the folders that only publications older than the newest `keep` name, and return them.

        Folders never published, such as those of a run still going on, are not touched. Readers that opened a
        table that many publications ago must be done.
        """
        path = f"{self.root}/_published"
        if keep < 1 or not path_exists(self.spark, path):
            return []
        log = self.spark.read.schema(PUBLISHED_SCHEMA).parquet(path)
        lists = log.select("version", F.explode("folders").alias("name", "entries")).filter(~F.col("name").startswith("_"))
        single = lists.select("version", "name", F.explode("entries").alias("entry"))
        folders = single.select("version", F.concat_ws("/", "name", "entry").alias("folder"))
        last_named = folders.groupBy("folder").agg(F.max("version").alias("version"))
        oldest_kept = self.published()[0] - keep + 1
        expired = [r.folder for r in last_named.filter(F.col("version") < oldest_kept).collect()]
        return [folder for folder in sorted(expired) if remove_path(self.spark, f"{self.root}/{folder}")]


def partition_of(folder: str) -> str:
    return folder.rsplit("/run=", 1)[0]


def by_partition(folders: Sequence[str]) -> dict[str, str]:
    """Folders by the partition they hold."""
    return {partition_of(folder): folder for folder in folders}


def one_row(spark: SparkSession, schema: T.StructType, values: list[Column]) -> DataFrame:
    """A single row in one partition, so that appending it adds one file and is visible at once or not at all."""
    return spark.range(1, numPartitions=1).select(*[v.alias(f.name) for v, f in zip(values, schema)])


def _located(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _located(spark, path)
    return files.exists(location)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder with its content; False if there was none."""
    files, location = _located(spark, path)
    return files.delete(location, True)


def new_run() -> str:
    """A folder name no other run uses, so a retried run never mixes with an earlier attempt."""
    return uuid.uuid4().hex
