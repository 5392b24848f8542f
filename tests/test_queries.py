"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__ as entry
from tests import compare

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan
    assert compare.compare(con, df, entry.oracle_sql().get(name)) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 2
