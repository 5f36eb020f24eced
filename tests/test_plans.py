"""Plan-shape guards: the scale properties the README claims, checked on the physical plan."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF01
from tickframe.plans import catalog

# Queries that write, stream or read a checkpointed copy: their final plan starts
# from files they wrote, not from the events scan.
WRITE_OR_STREAM = {"table_roundtrip", "csv_roundtrip", "parquet_roundtrip", "schema_evolution",
                   "sink_fanout", "stream_ticks", "stream_dedup", "union_append", "stream_ticks_multi_batch",
                   "stream_restated", "stream_dedup_exact", "sink_append_twice", "schema_checks",
                   "stream_late_polls", "sink_retry", "day_check_one_day", "tick_table_split_sessions"}


def _plan(spark, name):
    df = E.queries()[name](spark, SF01)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def static_plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan, before runtime re-planning
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


def test_tick_table_plan_shape(spark, static_plans):
    plan = _plan(spark, "tick_table")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len(scans) == 1 and sorted(c.split("#")[0] for c in scans[0].split(",")) == ["event_id", "event_type", "ts", "value"]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) == 3
    # The rank limit stands below the exchange by poll too: bars beyond the two newest are not shuffled.
    below = re.split(r"Exchange hashpartitioning\(symbol#\d+, session_date#\d+, poll_id#", plan)
    assert len(below) == 2 and all("WindowGroupLimit" in part for part in below)
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    for bad in ("Join", "CartesianProduct", "BroadcastNestedLoop", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in WRITE_OR_STREAM])
def test_no_cartesian_or_python_in_registered_queries(spark, static_plans, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython",
                "SortAggregate"):
        assert bad not in plan, (name, bad)
    assert plan.count("FileScan") >= 1
