import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import functions as fn

INTS = {
    None: None,
    "": None,
    " ": None,
    "12": 12,
    " 12 ": 12,
    "\t7\n": 7,
    "+5": 5,
    "-5": -5,
    "12.0": None,
    "12.7": None,
    "1e3": None,
    "1_000": 1000,
    "1__000": None,
    "_1": None,
    "1_": None,
    "1,234": None,
    "abc": None,
    "- 5": None,
    "0012": 12,
    "2147483647": 2147483647,
    "2147483648": None,
    "-2147483648": -2147483648,
    "+": None,
    "1 2": None,
}
DATES = {
    None: None,
    "": None,
    "2020-01-01T00:00:00.000": dt.date(2020, 1, 1),
    "2020-1-1": dt.date(2020, 1, 1),
    "2020-1-1T0": None,
    "2020-01": None,
    "2020": None,
    "2020-02-30": None,
    "2020-13-01": None,
    "2020-00-10": None,
    "20200101": None,
    "0000-01-01": None,
    " 2020-01-0": None,
    "2020-02-29": dt.date(2020, 2, 29),
    "2020-01- 5": dt.date(2020, 1, 5),
    "9999-12-31 23:59": dt.date(9999, 12, 31),
}


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_safe_int(spark):
    got = texts(spark, INTS).select("x", fn.safe_int(F.col("x")).alias("v")).collect()
    assert {r.x: r.v for r in got} == INTS


def test_int_overflows(spark):
    values = ["2147483648", "-2147483649", "2147483647", "12.7", "", None, "9_999_999_999", " 99999999999 ", "9__999999999"]
    got = texts(spark, values).select(fn.int_overflows(F.col("x")).alias("v")).collect()
    assert [r.v for r in got] == [True, True, False, False, False, False, True, True, False]


def test_safe_date(spark):
    got = texts(spark, DATES).select("x", fn.safe_date(F.col("x")).alias("v")).collect()
    assert {r.x: r.v for r in got} == DATES


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-_. e\t", max_size=9), min_size=1, max_size=400))
def test_safe_int_agrees_with_int(spark, values):
    def rule(text):
        try:
            return int(text)
        except ValueError:
            return None

    got = texts(spark, values).select("x", fn.safe_int(F.col("x")).alias("v")).collect()
    assert [r.v for r in got] == [rule(r.x) for r in got]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.from_regex(r"(19|20|00)[0-9]{1,2}-[0-9 ]{1,2}-[0-9 ]{1,2}", fullmatch=True), min_size=1, max_size=400))
def test_safe_date_agrees_with_strptime(spark, values):
    def rule(text):
        try:
            return dt.datetime.strptime(text[:10], "%Y-%m-%d").date()
        except ValueError:
            return None

    got = texts(spark, values).select("x", fn.safe_date(F.col("x")).alias("v")).collect()
    assert [r.v for r in got] == [rule(r.x) for r in got]


def test_any_flag(spark):
    rows = [(None, None), ("", None), ("0", None), (" ", ""), ("text", None), ("a", "b")]
    frame = spark.createDataFrame(rows, "a string, b string")
    got = frame.select(fn.any_flag([F.col("a"), F.col("b")]).alias("v")).collect()
    assert [r.v for r in got] == [False, False, True, True, True, True]


def test_share_pct(spark):
    rows = [(1, 3), (1, 8), (2, 3), (0, 5), (5, 0), (5, None), (None, 5), (201, 20000), (-1, 8), (1005, 100000), (3, 2)]
    got = spark.createDataFrame(rows, "a int, b int").select(fn.share_pct(F.col("a"), F.col("b")).alias("v"))
    want = ["33.33", "12.50", "66.67", "0.00", None, None, None, "1.01", "-12.50", "1.01", "150.00"]
    assert [r.v for r in got.collect()] == [None if w is None else Decimal(w) for w in want]


def test_share_pct_is_exact_near_halves(spark):
    """Halves missed or met by one unit, with totals near the 32-bit limit."""
    totals = [2_000_000_000, 1_999_999_999, 2_147_483_647, 160_000]
    rows = [(t * k // 20000 + d, t) for t in totals for k in (1, 3, 9999, 19999) for d in (-1, 0, 1) if t * k // 20000 + d > 0]
    got = spark.createDataFrame(rows, "a int, b int").select("a", "b", fn.share_pct(F.col("a"), F.col("b")).alias("v"))
    for r in got.collect():
        assert r.v == Decimal((2 * r.a * 10000 + r.b) // (2 * r.b)) / 100, (r.a, r.b)


def test_share_beyond_its_type_raises(spark):
    frame = spark.createDataFrame([(100, 1)], "a int, b int").select(fn.share_pct(F.col("a"), F.col("b")))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        frame.collect()


def test_exact_mean(spark):
    rows = [(10, 4), (1, 8), (-1, 8), (None, 0), (10**15 + 1, 3_000_000_000)]
    got = spark.createDataFrame(rows, "s bigint, n bigint").select(fn.exact_mean(F.col("s"), F.col("n")).alias("v"))
    want = ["2.50", "0.13", "-0.13", None, "333333.33"]
    assert [r.v for r in got.collect()] == [None if w is None else Decimal(w) for w in want]


def test_batch_id(spark):
    at = dt.datetime(2024, 3, 5, 6, 7, 8, 900000)
    frame = spark.createDataFrame([(at,)], "t timestamp_ntz").select(fn.batch_id(F.col("t"), "run_").alias("v"))
    assert frame.first().v == "run_20240305_060708"


def test_typed_values(spark):
    values = [12.7, -12.7, True, False, 3, "12", " 12.0", "", None, 0, 0.0, "0", [], [1], {}, {"a": 1}, 5_000_000_000]
    frame = spark.createDataFrame([(i, json.dumps({"k": v})) for i, v in enumerate(values)], "i int, j string")
    record = frame.select("i", F.from_json("j", T.StructType([T.StructField("k", T.VariantType())])).alias("r"))
    got = record.select(fn.typed_int(F.col("r.k")).alias("n"), fn.typed_flag(F.col("r.k")).alias("f")).orderBy("i").collect()
    ints = [12, -12, 1, 0, 3, 12, None, None, None, 0, 0, 0, None, None, None, None, None]
    assert [r.n for r in got] == ints
    assert [r.f for r in got] == [bool(v) for v in values]


def test_a_trailing_newline_is_no_part_of_a_date(spark):
    frame = spark.createDataFrame([("2020-01-1\n",), ("2020-01-01\n",), ("2020-01-1",)], "t string")
    got = [r[0] for r in frame.select(fn.safe_date(F.col("t"))).collect()]
    assert got[0] is None and got[1] == dt.date(2020, 1, 1) and got[2] == dt.date(2020, 1, 1)
