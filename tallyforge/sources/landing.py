"""Read landed JSON records. A record stays the text it arrived as."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources.paging import by_position


def read_landed(
    spark: SparkSession,
    path: str,
    layout: str = "lines",
    where: Column | None = None,
    order_by: list[str] | None = None,
    offset: int = 0,
    limit: int | None = None,
) -> DataFrame:
    """One row per record, column `raw_data`.

    layout "lines": one JSON object per line. layout "array": each file is a JSON array of objects; a damaged file
    raises. Both are split freely over tasks. `where` may use `field(key)`. `order_by` (record keys), `offset` and
    `limit` read one page; without them every record is read.
    """
    if layout == "lines":
        records = spark.read.text(path).select(F.col("value").alias("raw_data")).filter(F.trim("raw_data") != "")
    elif layout == "array":
        from tallyforge.sources.json_arrays import array_records  # needs pyarrow and numpy, in the tasks as well

        records = array_records(spark, path)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    if where is not None:
        records = records.filter(where)
    return page(records, order_by or [], offset, limit)


def field(key: str, raw: str = "raw_data") -> Column:
    """Text of one top-level field, NULL if absent."""
    return F.get_json_object(raw, f"$.{key}")


def spread(rows: DataFrame) -> DataFrame:
    """The rows on at least as many partitions as the session has cores.

    A small input in one file is one task, however costly its parsing. An input of more splits than cores, as any
    large one is, stays as it is and is not shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def page(records: DataFrame, order_by: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """One page of the source, sorted. Without a limit and an offset nothing is sorted or dropped."""
    if limit is None and offset == 0:
        return records
    if not order_by:
        raise ValueError("a page needs an order")
    keys = [field(key) for key in order_by]
    return by_position(records, keys, "raw_data", offset, limit).orderBy(*keys, "raw_data")
