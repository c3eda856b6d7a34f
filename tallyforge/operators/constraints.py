"""Table constraints that Parquet does not hold: key, NOT NULL, text length, number range."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.upsert import require_unique


class ConstraintError(ValueError):
    """Rows break constraints of their table; the message lists all of them with their counts."""


def describe(kind: str, column: str, limit: int | None, n: int) -> str:
    says = {"not_null": "is NULL", "max_length": f"is longer than {limit}", "int_range": "does not fit 32 bits"}
    return f"{column} {says[kind]} in {n} row{'s' * (n != 1)}"


def enforce(
    rows: DataFrame,
    schema: T.StructType,
    keys: Sequence[str] = (),
    lengths: dict[str, int] | None = None,
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows in the schema's columns and types; the query raises on a broken constraint.

    Casts are ANSI, so a number outside its type is an error, as are NULL in a required column and a text
    longer than its limit. `defaults` fill absent columns and NULLs. Keys, if given, must not repeat.
    """
    lengths, defaults = lengths or {}, defaults or {}
    absent = [f.name for f in schema if f.name not in rows.columns and f.name not in defaults]
    if absent:
        raise ValueError(f"columns missing: {', '.join(absent)}")

    def checked(f: T.StructField) -> Column:
        value = F.col(f.name) if f.name in rows.columns else F.lit(None)
        value = value.cast(f.dataType)
        if f.name in defaults:
            value = F.coalesce(value, defaults[f.name].cast(f.dataType))
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{f.name} is NULL")).cast(f.dataType))
        if f.name in lengths:
            limit = lengths[f.name]
            too_long = F.raise_error(F.lit(f"{f.name} is longer than {limit}")).cast(f.dataType)
            value = F.when(F.char_length(value) > limit, too_long).otherwise(value)
        return value.alias(f.name)

    typed = rows.select(*[checked(f) for f in schema])
    return require_unique(typed, keys) if keys else typed


def violations(
    rows: DataFrame,
    keys: Sequence[str] = (),
    required: Sequence[str] = (),
    lengths: dict[str, int] | None = None,
) -> DataFrame:
    """Count of violations per constraint: (constraint, column_name, violations), zeros included.

    One scan counts the row constraints; the key is counted from per-key totals, which each task forms
    before the shuffle.
    """
    tests = [("not_null", c, F.col(c).isNull()) for c in required]
    tests += [("max_length", c, F.char_length(c) > n) for c, n in (lengths or {}).items()]
    parts = []
    if tests:
        counted = rows.agg(*[F.count_if(test).alias(f"t{i}") for i, (_, _, test) in enumerate(tests)])
        parts.append(counts_to_rows(counted, [(kind, column) for kind, column, _ in tests]))
    if keys:
        per_key = rows.groupBy(*keys).count()
        repeated = per_key.agg(F.count_if(F.col("count") > 1).alias("t0"))
        parts.append(counts_to_rows(repeated, [("unique_key", ",".join(keys))]))
    if not parts:
        raise ValueError("no constraint given")
    return reduce(DataFrame.unionByName, parts)


def counts_to_rows(counted: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    """The single row of counts t0, t1, ... as (constraint, column_name, violations) rows."""
    entries = [
        F.struct(
            F.lit(kind).alias("constraint"),
            F.lit(column).alias("column_name"),
            F.col(f"t{i}").cast("bigint").alias("violations"),
        )
        for i, (kind, column) in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*entries)))
