"""Rows by their position in an order, without sorting more than the ranges at the ends of the page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Characters of the tie-breaking text that help to divide rows into ranges. Rows alike in keys and these share a range.
TIE_PREFIX = 64


def by_position(rows: DataFrame, keys: Sequence[Column], tie: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """The rows from position `offset` on, `limit` of them at most, in the order of `keys` and then of the text `tie`.

    The keys alone are dealt into ranges and counted: as many ranges as the session has shuffle partitions, and one row
    of each for the driver. Running sums of the counts tell which ranges the page touches. Rows of ranges inside the page
    are kept as they lie, and only the first and the last range are numbered. NULL keys come first. Rows that are equal
    in keys and tie may stand in for each other.
    """
    if offset < 0 or (limit is not None and limit < 0):
        raise ValueError("a page cannot begin or end before the first row")
    placed = rows.withColumn("_place", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], F.substring(tie, 1, TIE_PREFIX).alias("tie")))
    end = None if limit is None else offset + limit
    touched, before = [], 0
    for found in _ranges(placed.select("_place")):
        if (end is None or before < end) and before + found.n > offset:
            touched.append((before, found))
        before += found.n
    if not touched or limit == 0:
        return rows.limit(0)
    (first_at, first), (last_at, last) = touched[0], touched[-1]
    place = F.col("_place")
    at_front, at_back = place <= _literal(first.high), place >= _literal(last.low)
    edges = placed.filter((place >= _literal(first.low)) & (place <= _literal(last.high)) & (at_front | at_back))
    in_order = W.partitionBy(at_front).orderBy(*keys, tie)
    position = F.row_number().over(in_order) - 1 + F.when(at_front, first_at).otherwise(last_at)
    wanted = F.col("_position") >= offset
    if end is not None:
        wanted = wanted & (F.col("_position") < end)
    kept = edges.withColumn("_position", position).filter(wanted).select(*rows.columns)
    if len(touched) < 3:
        return kept
    return kept.unionByName(placed.filter((place > _literal(first.high)) & (place < _literal(last.low))).select(*rows.columns))


def _ranges(places: DataFrame) -> list[Row]:
    """(n, low, high) of every range that has rows, in order; their bounds do not overlap."""
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = places.repartitionByRange(tasks, "_place")
    counts = dealt.groupBy(F.spark_partition_id().alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_place").alias("low"), F.max("_place").alias("high")
    )
    return sorted(counts.collect(), key=lambda r: r.range)


def _literal(place: Row) -> Column:
    return F.struct(*[F.lit(value).cast("string").alias(name) for name, value in place.asDict().items()])
