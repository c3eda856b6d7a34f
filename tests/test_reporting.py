from decimal import Decimal as D

import pytest

from tallyforge.operators import reporting as R
from tallyforge.plans import mortality as M

COLUMNS = "jurisdiction string, year int, month int, all_cause int, covid_19_underlying int"


def impact(frame, entity):
    window = R.prior_year_window(frame, entity, "all_cause", "covid_19_underlying")
    join = R.prior_year_join(frame, entity, "all_cause", "covid_19_underlying")
    once = R.prior_year(frame, entity, "all_cause", "covid_19_underlying")
    a, b, c = (sorted(map(tuple, form.collect())) for form in (window, join, once))
    assert window.columns == join.columns == once.columns and window.dtypes == once.dtypes and a == b == c
    return {row[:-5]: row[-5:] for row in a}


def test_prior_year(spark):
    rows = [
        ("A", 2019, 1, 100, None),
        ("A", 2020, 1, 130, 10),
        ("A", 2022, 1, 90, 0),
        ("A", 2023, 1, 95, 5),
        ("A", 2020, 2, None, 1),
        ("A", 2021, 2, 50, 1),
        ("B", 2020, 1, 7, 7),
        ("B", 2021, 1, 0, 0),
    ]
    got = impact(spark.createDataFrame(rows, COLUMNS), ["jurisdiction"])
    assert got[("A", 2019, 1)] == (100, None, 100, None, None)
    assert got[("A", 2020, 1)] == (130, 10, 120, D("7.69"), 30)
    assert got[("A", 2022, 1)][-1] is None, "a missing year is not bridged"
    assert got[("A", 2023, 1)] == (95, 5, 90, D("5.26"), 5)
    assert got[("A", 2020, 2)] == (None, 1, None, None, None)
    assert got[("A", 2021, 2)][-1] is None, "an unknown prior total is not a change"
    assert got[("B", 2021, 1)] == (0, 0, 0, None, -7)


def test_prior_year_without_entity_raises_on_repeated_months(spark):
    frame = spark.createDataFrame([("A", 2019, 1, 1, 1), ("B", 2019, 1, 2, 1)], COLUMNS)
    with pytest.raises(Exception, match="repeated key: year=2020, month=1"):
        R.prior_year_join(frame, [], "all_cause", "covid_19_underlying").collect()


@pytest.mark.parametrize("form", [R.prior_year, R.prior_year_window])
def test_repeated_month_raises_in_every_form(spark, form):
    frame = spark.createDataFrame([("A", 2019, 1, 1, 1), ("A", 2019, 1, 2, 1)], COLUMNS)
    with pytest.raises(Exception, match="repeated key: .*year="):
        form(frame, ["jurisdiction"], "all_cause", "covid_19_underlying").collect()


def test_prior_year_takes_one_scan_and_one_exchange(spark, tmp_path):
    spark.createDataFrame([("A", 2019, 1, 1, 1)], COLUMNS).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    plan = R.prior_year(frame, [], "all_cause", "covid_19_underlying")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and "partial_max" in plan


SILVER_COUNTS = ", ".join(f"{c} int" for c in M.COUNTS)


def test_summary(spark):
    def row(year, total, heart, cancer):
        return (year, total, 0, heart, cancer, None, 1, 2, 3, 4)

    frame = spark.createDataFrame(
        [row(2020, 100, 10, None), row(2020, 200, 15, 7), row(2020, None, 1, None), row(2021, 0, 0, 0), row(2022, 10, None, 1)],
        f"year int, {SILVER_COUNTS}",
    )
    long = sorted(map(tuple, M.summary(frame).collect()))
    union = sorted(map(tuple, R.summary_union(frame, ["year"], "all_cause", M.CAUSES).collect()))
    assert long == union and len(long) == 18
    got = {(r[0], r[1]): r[2:] for r in long}
    assert got[(2020, "Heart Disease")] == (26, D("8.67"), D("8.67"))
    assert got[(2020, "Cancer")] == (7, D("7.00"), D("2.33")), "months without the measure stay in the denominator"
    assert got[(2020, "Diabetes")] == (None, None, None), "a measure without values keeps its row"
    assert got[(2021, "Heart Disease")] == (0, D("0.00"), None)


def test_summary_scans_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(2020, *range(9))], f"year int, {SILVER_COUNTS}").write.parquet(path)
    plan = M.summary(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hash") == 1 and "natural_cause" not in plan


def test_trends_need_no_shuffle(spark):
    frame = spark.createDataFrame([(2020, 1, 10, 0, 5, 15, 0, 0, None, 1, 0, True)], f"year int, month int, {SILVER_COUNTS}, is_provisional boolean")
    trends = M.trends(frame)
    assert "Exchange" not in trends._jdf.queryExecution().executedPlan().toString()
    assert tuple(trends.first()) == (2020, 1, 10, 5, 15, 1, None, D("50.00"), D("150.00"), D("10.00"), None, True)
