"""Reporting tables: shares of a total, a long summary per measure, change against the prior year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import exact_mean, share_pct
from tallyforge.operators.upsert import require_unique


def monthly_shares(
    rows: DataFrame,
    keys: Sequence[str],
    total: str,
    total_as: str,
    parts: dict[str, str],
    carry: Sequence[str] = (),
    count_suffix: str = "_deaths",
) -> DataFrame:
    """Keys, the total, each part's count, each part's share in percent, and carried columns. No shuffle.

    `parts` maps a measure column to its report name.
    """
    counts = [F.col(c).alias(f"{name}{count_suffix}") for c, name in parts.items()]
    shares = [share_pct(F.col(c), F.col(total)).alias(f"{name}_pct") for c, name in parts.items()]
    return rows.select(*keys, F.col(total).alias(total_as), *counts, *shares, *carry)


def summary_long(
    rows: DataFrame,
    by: Sequence[str],
    total: str,
    measures: dict[str, str],
    label: str = "cause",
    count_type: str = "bigint",
) -> DataFrame:
    """One row per group and measure: sum, mean per input row that has it, share of the group's total.

    The measures are aggregated together in one scan and one shuffle of partial sums, and only then turned
    into rows. The share's denominator includes rows whose measure is NULL. `measures` maps a column to its label.
    """
    sums = [F.sum(c).alias(f"sum_{c}") for c in measures]
    counts = [F.count(c).alias(f"n_{c}") for c in measures]
    wide = rows.groupBy(*by).agg(F.sum(total).alias("all_rows_total"), *sums, *counts)
    entries = [
        F.struct(
            F.lit(name).alias(label),
            F.col(f"sum_{c}").cast(count_type).alias("total_deaths"),
            exact_mean(F.col(f"sum_{c}"), F.col(f"n_{c}")).alias("avg_monthly_deaths"),
            share_pct(F.col(f"sum_{c}"), F.col("all_rows_total")).alias("pct_of_all_deaths"),
        )
        for c, name in measures.items()
    ]
    return wide.select(*by, F.inline(F.array(*entries)))


def summary_union(
    rows: DataFrame,
    by: Sequence[str],
    total: str,
    measures: dict[str, str],
    label: str = "cause",
    count_type: str = "bigint",
) -> DataFrame:
    """The summary as one grouped select per measure; same rows as `summary_long`, one scan each. For comparison."""
    result = None
    for c, name in measures.items():
        grouped = rows.groupBy(*by).agg(F.sum(c).alias("s"), F.count(c).alias("n"), F.sum(total).alias("t"))
        part = grouped.select(
            *by,
            F.lit(name).alias(label),
            F.col("s").cast(count_type).alias("total_deaths"),
            exact_mean(F.col("s"), F.col("n")).alias("avg_monthly_deaths"),
            share_pct(F.col("s"), F.col("t")).alias("pct_of_all_deaths"),
        )
        result = part if result is None else result.unionByName(part)
    return result


def _impact_columns(keys: Sequence[str], total: str, part: str, part_as: str):
    rest = F.col(total) - F.coalesce(F.col(part), F.lit(0))
    return [
        *[F.col(k) for k in keys],
        F.col(total).alias("total_deaths"),
        F.col(part).alias(f"{part_as}_deaths"),
        rest.alias(f"non_{part_as}_deaths"),
        share_pct(F.col(part), F.col(total)).alias(f"{part_as}_pct"),
        (F.col(total) - F.col("_prior")).alias("excess_vs_prev_year"),
    ]


def prior_year(
    rows: DataFrame,
    entity: Sequence[str],
    total: str,
    part: str,
    part_as: str = "covid",
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """Each row against the same entity and month one year before, in one scan and one shuffle.

    Every row is sent to its own year and, as a prior total, to the year after; one aggregate brings both together and
    sees whether a key repeats, which raises. Both are counted and reduced in each task before the shuffle, so a group
    of any size is a row per task.
    """
    keys = [*entity, year, month]
    kind = rows.schema[total].dataType.simpleString()
    own = F.struct(F.col(year), F.col(month), F.lit(True).alias("_own"), F.col(total).alias("_total"), F.col(part).alias("_part"))
    nothing = F.lit(None).cast(rows.schema[part].dataType).alias("_part")
    onward = F.struct((F.col(year) + 1).alias(year), F.col(month), F.lit(False).alias("_own"), F.col(total).alias("_total"), nothing)
    both = rows.select(*entity, F.inline(F.array(own, onward)))
    met = both.groupBy(*keys).agg(
        F.count_if("_own").alias("_n"),
        F.count_if(~F.col("_own")).alias("_n_prior"),
        F.max(F.when(F.col("_own"), F.col("_total"))).cast(kind).alias(total),
        F.max("_part").alias(part),
        F.max(F.when(~F.col("_own"), F.col("_total"))).alias("_prior"),
    )
    named = [F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys]
    repeated = F.raise_error(F.concat(F.lit("repeated key: "), F.concat_ws(", ", *named))).cast("boolean")
    sound = F.when((F.col("_n") > 1) | (F.col("_n_prior") > 1), repeated).otherwise(F.col("_n") == 1)
    return met.filter(sound).select(*_impact_columns(keys, total, part, part_as))


def prior_year_window(
    rows: DataFrame,
    entity: Sequence[str],
    total: str,
    part: str,
    part_as: str = "covid",
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """Each row against the same entity and month one year before, as a range window: one shuffle, no join.

    A window group has one row per year, and a key that repeats raises. A gap year gives NULL, which `lag` would not.
    For many years of one entity and month; `prior_year` gathers no group in one task.
    """
    by_year = Window.partitionBy(*entity, month).orderBy(year)
    prior, same = F.first(total).over(by_year.rangeBetween(-1, -1)), F.count(F.lit(1)).over(by_year.rangeBetween(0, 0))
    with_prior = rows.select(*entity, year, month, total, part, prior.alias("_prior"), same.alias("_same"))
    repeated = F.raise_error(F.concat_ws("", F.lit(f"repeated key: {year}="), year, F.lit(f", {month}="), month)).cast("boolean")
    with_prior = with_prior.filter(F.when(F.col("_same") > 1, repeated).otherwise(True))
    return with_prior.select(*_impact_columns([*entity, year, month], total, part, part_as))


def prior_year_join(
    rows: DataFrame,
    entity: Sequence[str],
    total: str,
    part: str,
    part_as: str = "covid",
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """The same as `prior_year_window`, as a left self-join. Rows that repeat a key raise instead of multiplying.

    The prior side carries four columns and is shifted before it is grouped, so grouping and join share one
    shuffle; adaptive execution may broadcast it when it measures small.
    """
    keys = [*entity, year, month]
    shifted = rows.select(*entity, (F.col(year) + 1).alias(year), month, F.col(total).alias("_prior"))
    prior = require_unique(shifted, keys)
    current = rows.select(*keys, total, part)
    return current.join(prior, keys, "left").select(*_impact_columns(keys, total, part, part_as))
