"""Pages by position against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.sources.paging import by_position


@pytest.fixture(scope="module")
def rows(spark):
    toss = random.Random(6)
    keys = [None, "", "a", "ab", "b", "é", "z"]
    made = [(toss.choice(keys), toss.choice([None, "1", "10", "2"]), f"{'t' * 70}{toss.randint(0, 40)}") for _ in range(400)]
    made += [("hot", "1", f"{i:05d}") for i in range(200)] + [("same", None, "x")] * 50
    frame = spark.createDataFrame(made, "k string, j string, raw_data string").repartition(5).persist()
    nulls_first = lambda v: (v is not None, (v or "").encode())
    return frame, sorted(made, key=lambda r: [nulls_first(v) for v in r])


@pytest.mark.parametrize("offset,limit", [(0, 1), (0, 7), (3, 0), (100, 250), (399, 1), (0, 650), (10, 10_000), (649, 5), (650, 5), (5, None), (640, None)])
def test_page_is_a_slice_of_the_order(rows, offset, limit):
    frame, ordered = rows
    got = by_position(frame, [F.col("k"), F.col("j")], "raw_data", offset, limit)
    expected = ordered[offset : None if limit is None else offset + limit]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


def test_pages_cover_everything_once(rows):
    frame, ordered = rows
    pages = [by_position(frame, [F.col("k"), F.col("j")], "raw_data", at, 90).collect() for at in range(0, 650, 90)]
    assert sorted(repr(tuple(r)) for page in pages for r in page) == sorted(map(repr, ordered))


def test_nothing_goes_through_one_task(rows):
    plan = by_position(rows[0], [F.col("k")], "raw_data", 20, 500)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "Limit" not in plan


def test_pages_of_nothing(spark, rows):
    empty = rows[0].limit(0)
    assert by_position(empty, [F.col("k")], "raw_data", 0, 5).count() == 0
    with pytest.raises(ValueError, match="page"):
        by_position(rows[0], [F.col("k")], "raw_data", -1, 5)
