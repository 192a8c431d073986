"""Every registered query runs on the smallest driver tables and its plan has
no cartesian product, no nested-loop join and no row-at-a-time Python UDF."""

import pytest

import __spark_entry__ as E
from small_tables import SF_SMALL

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_plan_and_runs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    for b in BAD:
        assert b not in plan, f"{name}: {b} in plan"
    df.limit(5).collect()


def test_entry_and_oracle_keys(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
