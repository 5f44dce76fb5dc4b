"""Every registered query against its SQL, on the smallest data set, and its plan."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracle import connect, differences
from tidemark.workload import oracle, queries

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(queries.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", queries.queries())
def test_query(spark, con, name):
    df = queries.queries()[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan
    assert differences(df, con, oracle.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "OrderDate"
