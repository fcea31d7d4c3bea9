"""Every registered query against its SQL, on the smallest test data."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import difference, from_duckdb, from_spark

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
# Queries of optional parts have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in entry.QUERIES}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in entry.ORACLE}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_agrees_with_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert difference(from_spark(df), from_duckdb(FOLDER, ORACLE[name])) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan


def test_entry(spark):
    assert {r["customer_type"] for r in entry.entry(spark).collect()} <= {"new", "returning"}
