"""Declarative data checks. A check counts violations and passes at zero; a failed report stops publication.

Per table, all row checks share one scan and one aggregate; uniqueness, group sizes and completeness share one
count per key, narrow and pre-aggregated in each task, which is rolled up instead of scanned again.

All counts add up over partitions if keys contain the partition columns. `check_state` keeps them per partition and
group, so that after a partial load only the partitions that changed are read, and `report_from_state` does the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    table: str
    name: str
    kind: str
    message: str


@dataclass(frozen=True)
class RowCheck(Check):
    """Rows for which the SQL condition holds are violations; a condition that is NULL is not one."""

    violation: str


@dataclass(frozen=True)
class NullOnlyInFirst(Check):
    """NULLs of `column` outside the least value of `period` are violations."""

    column: str
    period: str


@dataclass(frozen=True)
class Unique(Check):
    """Keys that occur more than once are violations."""

    keys: tuple[str, ...]


@dataclass(frozen=True)
class FullGroups(Check):
    """Groups with fewer than `size` rows are violations, except in the greatest `period`, which may be unfinished."""

    keys: tuple[str, ...]
    group: tuple[str, ...]
    period: str
    size: int


@dataclass(frozen=True)
class GroupSize(Check):
    """Groups that do not have exactly `size` rows are violations."""

    keys: tuple[str, ...]
    group: tuple[str, ...]
    size: int


@dataclass(frozen=True)
class MinRows(Check):
    """One violation if the table has fewer than `least` rows. Not among the fixed checks, which pass on empty tables."""

    least: int


def in_range(table: str, name: str, columns: Sequence[str], low, high) -> RowCheck:
    tests = [f"({c} < {low} OR {c} > {high})" for c in columns]
    return RowCheck(table, name, "validity", f"rows outside {low} to {high}", " OR ".join(tests))


def non_negative(table: str, name: str, columns: Sequence[str]) -> RowCheck:
    return RowCheck(table, name, "validity", "rows with negative values", " OR ".join(f"{c} < 0" for c in columns))


def parts_within_total(table: str, name: str, parts: Sequence[str], total: str) -> RowCheck:
    summed = " + ".join(f"coalesce({c}, 0)" for c in parts)
    return RowCheck(table, name, "consistency", "rows whose parts exceed the total", f"{summed} > {total}")


def parts_make_total(table: str, name: str, parts: Sequence[str], total: str) -> RowCheck:
    return RowCheck(table, name, "consistency", "rows whose parts differ from the total", f"{' + '.join(parts)} != {total}")


def report(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: table_name, check_name, kind, violations, passed, message."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        parts += _row_parts(tables[table], [c for c in mine if isinstance(c, (RowCheck, NullOnlyInFirst, MinRows))])
        parts += _group_parts(tables[table], [c for c in mine if isinstance(c, (Unique, FullGroups, GroupSize))])
    return reduce(DataFrame.unionByName, parts)


KEYED = (Unique, FullGroups, GroupSize)
PER_ROW = (RowCheck, NullOnlyInFirst, MinRows)


def _measured(check: Check) -> Column:
    """What a check counts in rows, before its counts are added up."""
    if isinstance(check, NullOnlyInFirst):
        return F.count_if(F.col(check.column).isNull())
    return F.count(F.lit(1)) if isinstance(check, MinRows) else F.count_if(F.expr(check.violation))


def _row_parts(rows: DataFrame, checks: list[Check]) -> list[DataFrame]:
    if not checks:
        return []
    counted = [_measured(check).alias(f"v{i}") for i, check in enumerate(checks)]
    return [_summed_rows(rows.groupBy(*_one_period(checks, NullOnlyInFirst)).agg(*counted), checks)]


def _one_period(checks: Sequence[Check], kind: type) -> list[str]:
    periods = list(dict.fromkeys(c.period for c in checks if isinstance(c, kind)))
    if len(periods) > 1:
        raise ValueError("checks that look at a period must use one period column per table and grouping")
    return periods


def _summed_rows(per_period: DataFrame, checks: list[Check]) -> DataFrame:
    """Report rows from counts v0, v1, ... per period. Rows without a period are neither before nor after the first one."""
    summed = []
    for i, check in enumerate(checks):
        v = F.col(f"v{i}")
        if isinstance(check, NullOnlyInFirst):
            total = F.sum(F.when(F.col(check.period).isNotNull(), v)) - F.min_by(v, check.period)
        elif isinstance(check, MinRows):
            total = (F.coalesce(F.sum(v), F.lit(0)) < check.least).cast("bigint")
        else:
            total = F.sum(v)
        summed.append(total.alias(f"v{i}"))
    return _as_rows(per_period.agg(*summed), checks)


def _group_parts(rows: DataFrame, checks: list[Check]) -> list[DataFrame]:
    parts = []
    for keys in dict.fromkeys(c.keys for c in checks):
        per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts += _keyed_parts(per_key, F.count_if(F.col("n") > 1), [c for c in checks if c.keys == keys])
    return parts


def _keyed_parts(counts: DataFrame, repeated: Column, checks: list[Check]) -> list[DataFrame]:
    """Report rows of checks of one key from counts `n`; `repeated` is the aggregate that counts repeated keys in them."""
    parts = []
    groups = list(dict.fromkeys(c.group for c in checks if not isinstance(c, Unique)))
    unique = [c for c in checks if isinstance(c, Unique)]
    if not groups:
        parts.append(_as_rows(counts.agg(*[repeated.alias(f"v{i}") for i in range(len(unique))]), unique))
    for at, group in enumerate(groups):
        mine = [*(unique if at == 0 else []), *[c for c in checks if not isinstance(c, Unique) and c.group == group]]
        per_group = counts.groupBy(*group).agg(F.sum("n").alias("n"), repeated.alias("repeated"))
        parts.append(_rolled_up(per_group, mine))
    return parts


def _rolled_up(per_group: DataFrame, checks: list[Check]) -> DataFrame:
    counted, summed = [], []
    for i, check in enumerate(checks):
        total = F.sum(f"v{i}")
        if isinstance(check, Unique):
            counted.append(F.sum("repeated").alias(f"v{i}"))
        elif isinstance(check, FullGroups):
            counted.append(F.count_if(F.col("n") < check.size).alias(f"v{i}"))
            total = F.sum(F.when(F.col(check.period).isNotNull(), F.col(f"v{i}"))) - F.max_by(f"v{i}", check.period)
        else:
            counted.append(F.count_if(F.col("n") != check.size).alias(f"v{i}"))
        summed.append(total.alias(f"v{i}"))
    return _as_rows(per_group.groupBy(*_one_period(checks, FullGroups)).agg(*counted).agg(*summed), checks)


# --- state that is merged instead of scanned again ------------------------------------------------------------


def _names(checks: Sequence[Check]) -> dict[str, Check]:
    """A column per row check, whose name changes with what the check counts."""
    return {f"v_{c.name}_{crc32(repr(c).encode()):08x}": c for c in checks if isinstance(c, PER_ROW)}


def _grain(checks: Sequence[Check], partitions: Sequence[str]) -> tuple[list[str], list[str]]:
    """The key that the checks of one table share, and the columns by which its state is kept."""
    key_sets = list(dict.fromkeys(c.keys for c in checks if isinstance(c, KEYED)))
    if len(key_sets) > 1:
        raise ValueError("checks whose state is kept must use one key per table")
    keys = list(key_sets[0]) if key_sets else []
    periods = [c.period for c in checks if isinstance(c, (NullOnlyInFirst, FullGroups))]
    grain = list(dict.fromkeys([*partitions, *periods, *[g for c in checks for g in getattr(c, "group", ())]]))
    if keys and not set(grain) <= set(keys):
        raise ValueError(f"the key must contain {', '.join(c for c in grain if c not in keys)}, for counts to add up")
    return keys, grain


def state_schema(schema: T.StructType, checks: Sequence[Check], partitions: Sequence[str]) -> T.StructType:
    """Columns of `check_state` for a table of the given schema."""
    kept = [schema[c] for c in _grain(checks, partitions)[1]]
    return T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in ("n", "repeated", *_names(checks))]])


def check_state(rows: DataFrame, checks: Sequence[Check], partitions: Sequence[str]) -> DataFrame:
    """Counts of one table's checks by partition, group and period: rows, repeated keys, and what each row check counts.

    One scan and one shuffle by key for all of them. States of different partitions are merged by putting them together,
    and a partition's state is replaced together with its rows.
    """
    keys, grain = _grain(checks, partitions)
    measures = [_measured(check).alias(name) for name, check in _names(checks).items()]
    per_key = rows.groupBy(*(keys or grain)).agg(F.count(F.lit(1)).alias("n"), *measures)
    repeated = F.count_if(F.col("n") > 1) if keys else F.lit(0).cast("bigint")
    sums = [F.sum(name).alias(name) for name in _names(checks)]
    return per_key.groupBy(*grain).agg(F.sum("n").alias("rows"), repeated.alias("repeated"), *sums).withColumnRenamed("rows", "n")


def report_from_state(states: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The same report as `report`, from the states of all partitions."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        named, keyed = _names(mine), [c for c in mine if isinstance(c, KEYED)]
        if named:
            counted = [F.sum(name).alias(f"v{i}") for i, name in enumerate(named)]
            per_period = states[table].groupBy(*_one_period(mine, NullOnlyInFirst)).agg(*counted)
            parts.append(_summed_rows(per_period, list(named.values())))
        if keyed:
            parts += _keyed_parts(states[table].drop(*named), F.sum("repeated"), keyed)
    return reduce(DataFrame.unionByName, parts)


def _as_rows(counted: DataFrame, checks: list[Check]) -> DataFrame:
    """The single row of counts v0, v1, ... as report rows. An empty table has no violations."""
    entries = []
    for i, check in enumerate(checks):
        n = F.coalesce(F.col(f"v{i}"), F.lit(0)).cast("bigint")
        entries.append(
            F.struct(
                F.lit(check.table).alias("table_name"),
                F.lit(check.name).alias("check_name"),
                F.lit(check.kind).alias("kind"),
                n.alias("violations"),
                (n == 0).alias("passed"),
                F.when(n > 0, F.concat_ws(" ", n.cast("string"), F.lit(check.message))).alias("message"),
            )
        )
    return counted.select(F.inline(F.array(*entries)))


def failing_groups(rows: DataFrame, check: FullGroups | GroupSize) -> DataFrame:
    """The groups that break a size check, with their row counts."""
    sizes = rows.groupBy(*check.group).agg(F.count(F.lit(1)).alias("row_count"))
    if isinstance(check, GroupSize):
        return sizes.filter(F.col("row_count") != check.size)
    latest = rows.agg(F.max(check.period)).scalar()
    return sizes.filter((F.col("row_count") < check.size) & (F.col(check.period) < latest))


def offenders(rows: DataFrame, check: Check, keys: Sequence[str], k: int = 3) -> DataFrame:
    """(table_name, check_name, nth, offender): the first `k` keys or groups that break a check, in their order.

    Every task keeps `k` rows at most. Row checks name a row by the table's `keys`.
    """
    if isinstance(check, MinRows):
        raise ValueError("no row offends a check of the number of rows")
    if isinstance(check, Unique):
        columns = list(check.keys)
        found = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    elif isinstance(check, (FullGroups, GroupSize)):
        columns, found = list(check.group), failing_groups(rows, check)
    elif isinstance(check, NullOnlyInFirst):
        columns = list(keys)
        first = rows.agg(F.min(check.period)).scalar()
        found = rows.filter(F.col(check.column).isNull() & (F.col(check.period) != first))
    else:
        columns, found = list(keys), rows.filter(check.violation)
    least = found.select(*columns).distinct().orderBy(*columns).limit(k)
    named = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in columns]
    nth = F.row_number().over(W.orderBy(*columns)).alias("nth")
    return least.select(F.lit(check.table).alias("table_name"), F.lit(check.name).alias("check_name"), nth, F.concat_ws(", ", *named).alias("offender"))


def all_offenders(tables: dict[str, DataFrame], checks: Sequence[Check], keys: dict[str, Sequence[str]], k: int = 3) -> DataFrame:
    """The offenders of several checks, which have some; `keys` by table."""
    return reduce(DataFrame.unionByName, [offenders(tables[c.table], c, keys[c.table], k) for c in checks if not isinstance(c, MinRows)])


class QualityError(RuntimeError):
    """Some checks failed; the message lists all of them, with the first rows or groups that offend."""


def gate(report_rows: DataFrame, explain: Callable[[list[str]], DataFrame | None] | None = None) -> list:
    """The report's rows if every check passed, else QualityError. Collects one row per check.

    `explain` gives the offenders of the named checks, None if they have none; it is asked only if some failed.
    """
    results = report_rows.collect()
    failed = [r for r in results if not r.passed]
    if not failed:
        return results
    examples: dict[str, list[str]] = {}
    if explain and (found := explain([f.check_name for f in failed])):
        for r in sorted(found.collect(), key=lambda r: r.nth):
            examples.setdefault(r.check_name, []).append(f"({r.offender})")
    says = [f"{r.table_name}: {r.check_name}: {r.message}" + "".join(f" {x}" for x in examples.get(r.check_name, [])) for r in failed]
    raise QualityError(f"{len(results) - len(failed)}/{len(results)} checks passed; " + "; ".join(says))
