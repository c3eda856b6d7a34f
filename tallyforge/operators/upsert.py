"""Keyed upsert: one row per key, chosen columns updated, rows absent from the source kept."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOADED_AT = "loaded_at"


def last_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The greatest row of every key, by `order` and then by all remaining columns, so that the choice is fixed.

    Spark applies a rank of one within each task before the shuffle too, so a key repeated in a large part of the
    rows sends one row per task.
    """
    ranks = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [F.col(c) for c in rows.columns if c not in [*keys, *(o for o in order if isinstance(o, str))]]
    greatest_first = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in [*ranks, *rest]])
    ranked = rows.withColumn("_rank", F.row_number().over(greatest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def require_unique(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; a repeated key raises when the query runs. Leaves the rows partitioned by key."""
    rest = [c for c in rows.columns if c not in keys]
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    named = [F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys]
    repeated = F.raise_error(F.concat(F.lit("repeated key: "), F.concat_ws(", ", *named)))
    return grouped.filter(F.when(F.col("_n") > 1, repeated.cast("boolean")).otherwise(True)).select(*rows.columns)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    run_ts: datetime | None = None,
    on_duplicate: str = "error",
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Target after the upsert.

    Matched rows take the `update` columns (default: all but the keys) from the source and keep the others;
    source rows without a match are added; target rows without a match stay. `loaded_at`, if the target has it,
    is `run_ts` on every row the source touched. A key repeated in the source raises, or with
    on_duplicate="last" its greatest row by `order` counts. Target keys are unique, as every merge leaves them.

    Both sides are shuffled by key, so read only the partitions of the target that the source touches.
    """
    columns = [c for c in target.columns if c not in keys and c != LOADED_AT]
    update = columns if update is None else list(update)
    source = source.select(*keys, *columns)
    if on_duplicate == "last":
        source = last_by_key(source, keys, order)
    elif on_duplicate == "error":
        source = require_unique(source, keys)
    else:
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")

    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = source.withColumn("_new", F.lit(True)).alias("new")
    now = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    picked = _picked(target.columns, keys, update, now)
    return old.join(new, list(keys), "full_outer").select(*picked)


def fold_batches(
    rows: DataFrame,
    keys: Sequence[str],
    batch: Sequence[str],
    update: Sequence[str],
    on_duplicate: str = "error",
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Rows of several batches as one row per key, as if the batches were merged one after the other.

    Batches follow each other in the order of the `batch` columns. The `update` columns come from the last batch that
    has the key, the others from the first. A key repeated inside one batch is treated as `on_duplicate` says.
    """
    once = [*keys, *batch]
    rows = last_by_key(rows, once, order) if on_duplicate == "last" else require_unique(rows, once)
    turn = F.struct(*batch)
    rest = [c for c in rows.columns if c not in once]
    return rows.groupBy(*keys).agg(*[(F.max_by if c in update else F.min_by)(c, turn).alias(c) for c in rest])


def _picked(names: Sequence[str], keys: Sequence[str], update: Sequence[str], now: Column) -> list[Column]:
    """Columns of the upserted row out of `old` and `new`, whose marks tell which of them exist."""
    from_new, from_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name == LOADED_AT:
            return F.when(from_new, now).otherwise(F.col(f"old.{name}")).alias(name)
        old_value, new_value = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in update:
            return F.when(from_new, new_value).otherwise(old_value).alias(name)
        return F.when(from_old, old_value).otherwise(new_value).alias(name)

    return [pick(c) for c in names]
