import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators import parse as P
from tallyforge.operators.constraints import enforce, violations
from tallyforge.plans import mortality as M


def bronze(spark, records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame([(t,) for t in texts], "raw_data string")


RECORDS = [
    {"jurisdiction_of_occurrence": "US", "year": "2020", "month": "1", "all_cause": "10", "covid_19_underlying_cause": "3"},
    {"jurisdiction_of_occurrence": "US", "month": "1"},
    {"jurisdiction_of_occurrence": "US", "year": "2020"},
    {"year": "twenty", "month": "1"},
    "{not json",
    {"year": "2020", "month": "13", "flag_mva": "0", "unknown": "x"},
    {"year": "2020", "month": "2", "jurisdiction_of_occurrence": None, "flag_mva": ""},
    "",
]


@pytest.mark.parametrize("typed", [False, True])
@pytest.mark.parametrize("filters_follow", [False, True])
def test_rows_and_rejects(spark, typed, filters_follow):
    parsed = P.parse(bronze(spark, RECORDS), M.SPEC, typed, filters_follow)
    rows = P.accepted(parsed, M.SPEC)
    assert rows.columns == list(M.SPEC.order)
    got = {(r.jurisdiction, r.year, r.month): r for r in rows.collect()}
    assert set(got) == {("US", 2020, 1), (None, 2020, 13), (None, 2020, 2)}
    assert got[("US", 2020, 1)].covid_19_underlying == 3 and got[("US", 2020, 1)].drug_overdose is None
    assert got[(None, 2020, 13)].is_provisional and not got[(None, 2020, 2)].is_provisional
    reasons = sorted((r.reject_reason, r.raw_data) for r in P.rejected(parsed).collect())
    assert [r for r, _ in reasons] == ["bad_json", "bad_json", "no_month", "no_year", "no_year"]


def test_typed_numbers(spark):
    records = [{"jurisdiction_of_occurrence": "US", "year": 2020, "month": 1.9, "all_cause": True, "flag_mva": 0, "flag_suic": 1}]
    row = P.accepted(P.parse(bronze(spark, records), M.SPEC, typed_json=True), M.SPEC).first()
    assert (row.year, row.month, row.all_cause, row.is_provisional) == (2020, 1, 1, True)


def test_json_is_parsed_once_below_filters(spark):
    plan = P.accepted(P.parse(bronze(spark, RECORDS), M.SPEC), M.SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Python" not in plan


def test_stage_counts(spark):
    counts = {r.stage: r.n for r in P.stage_counts(P.parse(bronze(spark, RECORDS), M.SPEC)).collect()}
    assert counts == {"received": 8, "inserted": 8, "transformed": 3, "dropped": 5, "upserted": 3}


def test_overflowing(spark):
    records = [{"year": "2020", "month": "1", "all_cause": "99999999999"}, {"year": "1", "month": "1", "all_cause": "7"}]
    got = {r.column_name: r.violations for r in P.overflowing(bronze(spark, records), M.SPEC).collect()}
    assert got["all_cause"] == 1 and sum(got.values()) == 1


def table(spark, rows):
    return spark.createDataFrame(rows, "jurisdiction string, year int, month int")


SILVER_START = T.StructType(M.SILVER.schema.fields[:3])


@pytest.mark.parametrize(
    "row, message",
    [((None, 2020, 1), "jurisdiction is NULL"), (("x" * 101, 2020, 1), "longer than 100"), (("US", 2020, 1), "repeated key")],
)
def test_enforce_raises(spark, row, message):
    rows = table(spark, [("US", 2020, 1), row])
    checked = enforce(rows, SILVER_START, M.SILVER_KEYS, {"jurisdiction": 100})
    with pytest.raises(Exception, match=message):
        checked.collect()


def test_enforce_defaults_and_types(spark):
    rows = table(spark, [("US", 2020, 1)]).withColumn("year", F.col("year").cast("bigint"))
    schema = T.StructType([*SILVER_START.fields, T.StructField("is_provisional", T.BooleanType(), False)])
    row = enforce(rows, schema, defaults={"is_provisional": F.lit(False)}).first()
    assert tuple(row) == ("US", 2020, 1, False)
    with pytest.raises(ValueError, match="is_provisional"):
        enforce(rows, schema)
    big = rows.withColumn("year", F.lit(3_000_000_000))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        enforce(big, SILVER_START).collect()


def test_violations(spark):
    rows = table(spark, [("US", 2020, 1), ("US", 2020, 1), ("US", 2020, 1), (None, 2020, 2), ("y" * 101, 2020, 3)])
    got = {(r[0], r[1]): r[2] for r in violations(rows, M.SILVER_KEYS, ["jurisdiction"], {"jurisdiction": 100}).collect()}
    assert got == {("not_null", "jurisdiction"): 1, ("max_length", "jurisdiction"): 1, ("unique_key", "jurisdiction,year,month"): 1}
