"""Plan guardrails for every registered query (sf0.001 inputs)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "Window "]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_slow_path(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name,column", [("filter_ne", "c_mktsegment"), ("date_range_count", "o_orderdate"),
                                         ("join_inner", "o_orderstatus"), ("upsert_orders", "o_orderdate")])
def test_filters_reach_the_scan(spark, name, column):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any(column in line.split("PushedFilters")[1] for line in pushed), plan


def test_projection_is_pruned(spark):
    plan = _plan(QUERIES["literal_column"](spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint>" in plan
