"""Plan checks: no nested-loop or Cartesian joins, no single-partition
exchange feeding an aggregate over raw rows, pruned scans."""

import re

import pytest

import __spark_entry__ as entry
from cadence.plans.registry import QUERIES
from tests.conftest import SF001

NAMES = sorted(QUERIES)
# Queries whose last plan reads only tables written by their earlier steps.
WRITES_FIRST = {
    "moving_average_of_orders",
    "previous_order_of_customer",
    "orders_to_date",
    "retention_kept_up",
    "interval_retention_kept_up",
    "retention_rolled_up",
    "growth_of_kept_view",
    "extremes_of_kept_view",
    "retention_by_dimension_bucketed",
    "retention_from_pruned_years",
}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("name", NAMES)
def test_scans_are_pruned(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    # Scans of the given tables; what a query itself writes between its steps it reads whole.
    given = [line for line in plan.splitlines() if "FileScan" in line and SF001 in line]
    assert given or name in WRITES_FIRST
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", "\n".join(given)):
        cols = schema.split(",")
        assert len(cols) <= 4, schema
        assert not any(c.startswith(("o_comment", "c_name", "c_acctbal", "props")) for c in cols)


@pytest.mark.parametrize("name", NAMES)
def test_no_python_udfs(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_single_partition_only_above_aggregates(spark):
    """Whole-series windows run on aggregated data: every SinglePartition
    exchange has an aggregate below it."""
    for name in NAMES:
        plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan()
        text = plan.treeString()
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = "\n".join(lines[i + 1 :])
                assert "HashAggregate" in below or "SortAggregate" in below, name


def test_category_filter_reaches_the_scan(spark):
    plan = _plan(entry.queries()["panel"](spark, SF001))
    assert re.search(r"PushedFilters: \[[^\]]*In\(c_mktsegment", plan), plan


def test_cohort_range_filter_sits_on_the_aggregate(spark):
    df = entry.queries()["retention_by_dimension_range"](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "first_term" in plan and "1995-02-01" in plan


@pytest.mark.parametrize(
    "name", ["sparse_trailing_rows", "rolling_sparse_range", "rolling_sparse_window", "rolling_sparse_lead_in"]
)
def test_spine_bounds_reach_the_scan(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate[^\]]*LessThan\(o_orderdate", plan), plan


@pytest.mark.parametrize("name", [n for n in NAMES if n.endswith("_by_segment")])
def test_keyed_series_stay_partitioned(spark, name):
    assert "SinglePartition" not in _plan(entry.queries()[name](spark, SF001))
