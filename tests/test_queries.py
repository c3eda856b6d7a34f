"""Every registered query against its SQL."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from workload.checks_sql import ORACLES as SQL
from workload.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert entry.queries().items() >= QUERIES.items() and entry.oracle_sql().items() >= SQL.items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan
    assert difference(frame, duck, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
