"""The registered queries that SQL can express, against their SQL."""

from pathlib import Path

import pytest

from opinara.llm.oracles import ORACLES
from opinara.llm.queries import QUERIES
from oracle_check import compare, connect


@pytest.fixture(scope="module")
def database(small_dir):
    return connect(Path(small_dir))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small_dir, database, name):
    assert compare(QUERIES[name](spark, small_dir), database, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["op2_mix_sources", "op4_extendible_shards"])
def test_native_queries_run_no_python(spark, small_dir, name):
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if word in plan]
