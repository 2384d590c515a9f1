"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import oracle
import pytest

from suite import ORACLES, QUERIES

# Joins of everything with everything, and rows handed to Python.
SLOW_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas")


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    assert oracle.compare(df, duck, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in SLOW_NODES if node in plan]
