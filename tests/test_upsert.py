import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.upsert import fold_batches, last_by_key, merge, require_unique

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
SCHEMA = "k string, y int, start string, n int, loaded_at timestamp"


def rows(frame):
    return {tuple(r)[:2]: tuple(r)[2:] for r in frame.collect()}


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, "s0", 1, T0), ("b", 1, "s0", 2, T0), ("d", 1, None, 4, T0)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("b", 1, "s1", 20), ("c", 1, "s1", 30), ("d", 1, "s1", None)], "k string, y int, start string, n int")


def test_cases_of_the_upsert(target, source):
    got = rows(merge(target, source, ["k", "y"], ["n"], T1))
    assert got == {
        ("a", 1): ("s0", 1, T0),
        ("b", 1): ("s0", 20, T1),
        ("c", 1): ("s1", 30, T1),
        ("d", 1): (None, None, T1),
    }


def test_all_columns_by_default(target, source):
    got = rows(merge(target, source, ["k", "y"], run_ts=T1))
    assert got[("b", 1)] == ("s1", 20, T1) and got[("a", 1)] == ("s0", 1, T0)


def test_twice_is_once(target, source):
    once = merge(target, source, ["k", "y"], ["n"], T1)
    assert rows(merge(once, source, ["k", "y"], ["n"], T1)) == rows(once)


def test_disjoint_batches_commute(spark, target):
    one = spark.createDataFrame([("x", 1, "s", 1)], "k string, y int, start string, n int")
    two = spark.createDataFrame([("y", 1, "s", 2)], "k string, y int, start string, n int")
    ab = merge(merge(target, one, ["k", "y"], run_ts=T1), two, ["k", "y"], run_ts=T1)
    ba = merge(merge(target, two, ["k", "y"], run_ts=T1), one, ["k", "y"], run_ts=T1)
    assert rows(ab) == rows(ba)


def test_empty_sides(spark, target, source):
    empty_source = source.filter("n > 1000")
    assert rows(merge(target, empty_source, ["k", "y"], run_ts=T1)) == rows(target)
    added = rows(merge(target.filter("n > 1000"), source, ["k", "y"], run_ts=T1))
    assert added == {k: (*v, T1) for k, v in rows(source).items()}


def test_repeated_key_raises(target, source):
    with pytest.raises(Exception, match="repeated key: k=b, y=1"):
        merge(target, source.unionByName(source), ["k", "y"], run_ts=T1).collect()


def test_repeated_key_last_wins(target, source):
    doubled = source.unionByName(source.withColumn("n", F.col("n") + 5))
    got = rows(merge(target, doubled, ["k", "y"], ["n"], T1, on_duplicate="last", order=["n"]))
    assert got[("b", 1)] == ("s0", 25, T1) and got[("c", 1)] == ("s1", 35, T1) and got[("d", 1)] == (None, None, T1)


def test_last_by_key_is_fixed_by_all_columns(spark):
    frame = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("a", None, 9), ("b", None, None)], "k string, o int, v int")
    assert sorted(map(tuple, last_by_key(frame, ["k"], ["o"]).collect())) == [("a", 1, 3), ("b", None, None)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of all rows share one key: at most one of them per input task crosses the shuffle."""
    frame = spark.range(0, 30000, 1, 4).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    kept = last_by_key(frame, ["k"], ["v"])
    assert kept.count() == 20001 and kept.filter("k = -1").first().v == 29997
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_require_unique_keeps_rows(spark):
    frame = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    assert sorted(map(tuple, require_unique(frame, ["k"]).collect())) == [("a", None), ("b", 2)]


def test_unique_guard_and_join_share_a_shuffle(spark, target, source):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge(target, source, ["k", "y"], run_ts=T1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("on_duplicate", ["error", "last"])
def test_folded_batches_equal_one_merge_after_the_other(spark, on_duplicate):
    target = spark.createDataFrame([("a", 1, "x", T0), ("e", 9, "y", T0)], "k string, n int, first string, loaded_at timestamp")
    batches = [("a", 2, "p", 1), ("b", 3, "q", 1), ("b", 4, "r", 2), ("c", None, "s", 2), ("c", 5, "t", 3), ("b", None, "u", 3), ("b", 6, "v", 4)]
    frame = spark.createDataFrame(batches, "k string, n int, first string, at int")
    stepwise = target
    for at in (1, 2, 3, 4):
        stepwise = merge(stepwise, frame.filter(f"at = {at}").drop("at"), ["k"], ["n"], T1)
    folded = fold_batches(frame, ["k"], ["at"], ["n"], on_duplicate, ["n"])
    at_once = merge(target, folded, ["k"], ["n"], T1)
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, stepwise.collect()))


def test_key_repeated_inside_a_batch(spark):
    frame = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 0, 2)], "k string, n int, at int")
    with pytest.raises(Exception, match="repeated key: k=a, at=1"):
        fold_batches(frame, ["k"], ["at"], ["n"]).collect()
    assert fold_batches(frame.filter("at = 1"), ["k"], ["at"], ["n"], "last", ["n"]).first().n == 2
