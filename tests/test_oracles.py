"""Every registered query that SQL can express, against its oracle; the others by shape."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, connect

SLOW = {"run_grid", "scaling_study", "scaling_summary", "train_rf", "train_gbt"}


@pytest.fixture(scope="module")
def database(small_dir):
    return connect(Path(small_dir))


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def forbidden_operators(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [operator for operator in FORBIDDEN if operator in plan]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, small_dir, database, name):
    df = queries()[name](spark, small_dir)
    assert forbidden_operators(df) == []
    assert compare(df, database, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_query_without_sql_has_rows(spark, small_dir, name):
    df = queries()[name](spark, small_dir)
    assert forbidden_operators(df) == []
    assert df.count() > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert [row.bucket_no for row in rows] == sorted(row.bucket_no for row in rows)
    assert sum(row.cnt for row in rows) == 87
