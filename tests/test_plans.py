"""Plan shape of every registered query: no pair-producing joins, no Python
UDFs, single-partition exchanges only on bounded inputs, top-k pushed below
the shuffle."""

import contextlib
import io

import pytest

from citybeat.plans.catalog import queries
from tests.conftest import SF0001

# Single-partition exchanges that are fine: shares over already-aggregated
# category rows, and global aggregates of bounded inputs (the list of modes,
# the graph's largest node id).
BOUNDED_SINGLE_PARTITION = {
    "provider_share", "type_share", "member_share", "borough_avg", "latest_year_share", "mode_share",
    "edge_travel_time", "induced_subgraph",
}


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        queries()[name](spark, SF0001).explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_shape(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
    if "Exchange SinglePartition" in plan:
        assert name in BOUNDED_SINGLE_PARTITION, name


@pytest.mark.parametrize("name", ["top_zones", "top_od"])
def test_group_top_k_is_limited_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    assert plan.count("WindowGroupLimit") >= 2  # partial + final
    assert plan.count("l_returnflag:string") == 1  # the fact table is scanned once


def test_fallback_top_k_uses_a_group_limit(spark):
    # its input is already partitioned by service (windows over the service), so
    # there is no shuffle to push a partial limit below
    plan = _plan(spark, "top_items_with_fallback")
    assert "WindowGroupLimit" in plan and plan.count("l_returnflag:string") == 1


def test_trip_scan_prunes_and_pushes(spark):
    plan = _plan(spark, "trips_monthly")
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>" in plan
    assert "GreaterThanOrEqual(l_shipdate" in plan
