from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import quality as Q
from tallyforge.plans import mortality as M

LAYOUTS = M.gold_layouts()


def clean(spark):
    trends = [
        (y, m, 200000, 100, 100, 100, 100, D("0.05"), D("0.05"), D("0.05"), D("0.05"), False, None)
        for y in (2020, 2021)
        for m in range(1, 13)
    ] + [(2022, 1, 200000, 1, 1, None, 1, D(0), D(0), None, D(0), True, None)]
    summary = [(y, c, 10, D("1.5"), D("3.3"), None) for y in (2020, 2021) for c in M.CAUSES.values()]
    impact = [(y, m, 10, 3, 7, D("30"), None if y == 2020 else 0, None) for y in (2020, 2021) for m in (1, 2)]
    impact.append((2020, 3, 10, None, 10, None, None, None))
    data = {"trends": trends, "summary": summary, "impact": impact}
    return {n: spark.createDataFrame(data[n], LAYOUTS[n].schema) for n in data}


def set_where(frame, condition, **values):
    for name, value in values.items():
        frame = frame.withColumn(name, F.when(F.expr(condition), F.lit(value)).otherwise(F.col(name)))
    return frame


def repeat(frame, condition):
    return frame.unionByName(frame.filter(condition))


PLANT = {
    "trends_unique": ("trends", lambda t: repeat(t, "year = 2020 AND month < 3"), 2),
    "trends_full_years": ("trends", lambda t: t.filter("NOT (year = 2021 AND month = 5)"), 1),
    "trends_total_range": ("trends", lambda t: set_where(t, "month = 4", total_deaths=99999), 2),
    "trends_non_negative": ("trends", lambda t: set_where(t, "month = 4", covid_deaths=-1), 2),
    "trends_causes_le_total": ("trends", lambda t: set_where(t, "month = 4", cancer_deaths=300000), 2),
    "trends_pct_range": ("trends", lambda t: set_where(t, "month = 4", cancer_pct=D("100.01"), covid_pct=D("-1")), 2),
    "summary_unique": ("summary", lambda t: repeat(t, "cause = 'Cancer'"), 2),
    "summary_group_size": ("summary", lambda t: t.filter("NOT (year = 2021 AND cause = 'Cancer')"), 1),
    "summary_pct_range": ("summary", lambda t: set_where(t, "cause = 'Cancer'", pct_of_all_deaths=D("101")), 2),
    "summary_non_negative": ("summary", lambda t: set_where(t, "cause = 'Cancer'", avg_monthly_deaths=D("-0.5")), 2),
    "impact_unique": ("impact", lambda t: repeat(t, "month = 1"), 2),
    "impact_parts_sum": ("impact", lambda t: set_where(t, "month = 1", non_covid_deaths=8), 2),
    "impact_pct_range": ("impact", lambda t: set_where(t, "month = 1", covid_pct=D("100.5")), 2),
    "impact_nulls_earliest_only": ("impact", lambda t: set_where(t, "month = 1", excess_vs_prev_year=None), 1),
    "impact_non_negative": ("impact", lambda t: set_where(t, "month = 3", non_covid_deaths=-10), 1),
}


def test_clean_tables_pass(spark):
    report = Q.gate(Q.report(clean(spark), M.checks()))
    assert len(report) == 15 and all(r.passed and r.violations == 0 and r.message is None for r in report)


def test_empty_tables_pass_unless_rows_are_asked_for(spark):
    empty = {n: f.limit(0) for n, f in clean(spark).items()}
    assert all(r.passed for r in Q.report(empty, M.checks()).collect())
    least = Q.MinRows("trends", "trends_rows", "completeness", "table too small", 1)
    with pytest.raises(Q.QualityError, match="trends_rows: 1 table too small"):
        Q.gate(Q.report(empty, [*M.checks(), least]))


@pytest.mark.parametrize("name", PLANT)
def test_planted_violation(spark, name):
    table, change, count = PLANT[name]
    tables = clean(spark)
    tables[table] = change(tables[table])
    check = next(c for c in M.checks() if c.name == name)
    row = Q.report(tables, [check]).first()
    assert (row.table_name, row.check_name, row.violations, row.passed) == (table, name, count, False)


def test_gate_lists_every_failure(spark):
    tables = clean(spark)
    for name in ("trends_total_range", "impact_unique"):
        table, change, _ = PLANT[name]
        tables[table] = change(tables[table])
    with pytest.raises(Q.QualityError, match="13/15 checks passed.*trends_total_range.*impact_unique"):
        Q.gate(Q.report(tables, M.checks()))


def test_latest_year_may_be_unfinished_only_if_it_is_latest(spark):
    trends = clean(spark)["trends"].filter("year < 2022 AND NOT (year = 2021 AND month = 1)")
    check = next(c for c in M.checks() if c.name == "trends_full_years")
    assert Q.report({"trends": trends}, [check]).first().violations == 0
    assert Q.failing_groups(trends, check).count() == 0


def test_failing_groups(spark):
    tables = clean(spark)
    short = tables["trends"].filter("NOT (year = 2020 AND month > 10)")
    check = next(c for c in M.checks() if c.name == "trends_full_years")
    assert [tuple(r) for r in Q.failing_groups(short, check).collect()] == [(2020, 10)]
    sizes = next(c for c in M.checks() if c.name == "summary_group_size")
    assert [tuple(r) for r in Q.failing_groups(repeat(tables["summary"], "year = 2020"), sizes).collect()] == [(2020, 12)]


def test_checks_of_one_table_share_scans(spark, tmp_path):
    path = str(tmp_path / "trends")
    clean(spark)["trends"].write.parquet(path)
    checks = [c for c in M.checks() if c.table == "trends"]
    plan = Q.report({"trends": spark.read.parquet(path)}, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_two_groupings_of_one_key(spark):
    base = next(c for c in M.checks() if c.name == "summary_group_size")
    other = replace(base, name="per_cause", group=("cause",), size=2)
    unique = next(c for c in M.checks() if c.name == "summary_unique")
    got = {r.check_name: r.violations for r in Q.report(clean(spark), [base, other, unique]).collect()}
    assert got == {"summary_group_size": 0, "per_cause": 0, "summary_unique": 0}


# --- kept state and offenders ---------------------------------------------------------------------------------

KEYS = M.gold_keys()


def states(tables, checks):
    return {n: Q.check_state(f, [c for c in checks if c.table == n], LAYOUTS[n].partitions) for n, f in tables.items()}


def all_planted(spark):
    tables = clean(spark)
    for table, change, _ in PLANT.values():
        tables[table] = change(tables[table])
    return tables


def test_report_from_state_equals_the_report(spark):
    tables, checks = all_planted(spark), [*M.checks(), Q.MinRows("trends", "trends_rows", "completeness", "too small", 1000)]
    whole = sorted(map(tuple, Q.report(tables, checks).collect()), key=str)
    assert sorted(map(tuple, Q.report_from_state(states(tables, checks), checks).collect()), key=str) == whole
    empty = {n: f.limit(0) for n, f in tables.items()}
    assert all(r.passed for r in Q.report_from_state(states(empty, M.checks()), M.checks()).collect())


def test_states_of_partitions_add_up(spark):
    tables, checks = all_planted(spark), M.checks()
    early = states({n: f.filter("year = 2020") for n, f in tables.items()}, checks)
    late = states({n: f.filter("year > 2020") for n, f in tables.items()}, checks)
    merged = {n: early[n].unionByName(late[n]) for n in early}
    assert sorted(map(str, Q.report_from_state(merged, checks).collect())) == sorted(map(str, Q.report(tables, checks).collect()))
    for name, frame in early.items():
        mine = [c for c in checks if c.table == name]
        assert frame.schema.simpleString() == Q.state_schema(LAYOUTS[name].schema, mine, LAYOUTS[name].partitions).simpleString()


def test_state_changes_its_columns_with_the_checks(spark):
    low, high = ([c for c in M.checks(low=n) if c.table == "trends"] for n in (1, 2))
    schemas = [Q.state_schema(LAYOUTS["trends"].schema, checks, ("year", "month")) for checks in (low, high)]
    assert schemas[0] != schemas[1]
    per_month = Q.GroupSize("trends", "per_cause", "completeness", "x", ("year", "month"), ("cause",), 1)
    with pytest.raises(ValueError, match="the key must contain cause"):
        Q.state_schema(LAYOUTS["summary"].schema, [per_month], ("year",))


def test_rows_without_a_period_are_not_after_the_first(spark):
    rows = spark.createDataFrame([(None, 1, None), (2020, 1, None), (2021, 1, 5), (2021, 2, None)], "year int, month int, x int")
    nulls = Q.NullOnlyInFirst("t", "nulls", "precision", "NULLs", "x", "year")
    full = Q.FullGroups("t", "full", "completeness", "short", ("year", "month"), ("year",), "year", 2)
    got = {r.check_name: r.violations for r in Q.report({"t": rows}, [nulls, full]).collect()}
    assert got == {"nulls": 1, "full": 1}
    state = {"t": Q.check_state(rows, [nulls, full], ("year",))}
    assert {r.check_name: r.violations for r in Q.report_from_state(state, [nulls, full]).collect()} == got


def test_first_offenders_are_named(spark):
    tables = all_planted(spark)
    found = Q.all_offenders(tables, M.checks(), KEYS, 2).collect()
    assert {r.check_name for r in found} == set(PLANT) and all(r.nth <= 2 for r in found)
    named = {(r.check_name, r.nth): r.offender for r in found}
    assert named[("trends_unique", 1)] == "year=2020, month=1" and named[("trends_unique", 2)] == "year=2020, month=2"
    assert named[("trends_full_years", 1)] == "year=2021" and named[("summary_pct_range", 1)] == "year=2020, cause=Cancer"


def test_gate_names_offenders(spark):
    tables, checks = all_planted(spark), M.checks()
    explain = lambda names: Q.all_offenders(tables, [c for c in checks if c.name in names], KEYS)
    with pytest.raises(Q.QualityError, match=r"trends_total_range: 2 rows outside 100000 to 500000 \(year=2020, month=4\) \(year=2021, month=4\)"):
        Q.gate(Q.report(tables, checks), explain)
