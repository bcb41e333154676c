"""Plan invariants over every registered batch query (static plan: AQE off, no broadcast)."""

import re

import pytest

import __spark_entry__ as E
from pumpguard.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = sorted(n for n in QUERIES
               if not n.startswith(("stream_", "anomaly_", "compact_", "partitioned_",
                                    "alerts_jdbc")))


@pytest.fixture(scope="module")
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {n: E.queries()[n](spark, SF)._jdf.queryExecution().executedPlan().toString()
               for n in BATCH}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_batch_plan_invariants(static_plans, name):
    plan = static_plans[name]
    # no Python in the batch path
    for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert op not in plan, f"{name}: {op}"
    # no cross joins, no all-pairs
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    # every window is partitioned (nothing funnelled into one task by a window)
    for spec in re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan):
        assert spec.strip(), f"{name}: unpartitioned window"
    # a single-partition exchange only feeds a global aggregate or a top-k
    for m in re.finditer(r"Exchange SinglePartition", plan):
        assert ("HashAggregate(keys=[]" in plan or "TakeOrderedAndProject" in plan
                or "Union" in plan), f"{name}: unexpected single-partition exchange"
    # the scans carry an explicit (pruned) read schema
    assert "FileScan" in plan and "ReadSchema: struct<" in plan


def test_velocity_expands_counted_panes(static_plans):
    """Rows are counted per pane before the panes are expanded to their windows."""
    plan = static_plans["sliding_velocity_by_dimension"]
    top_down = re.findall(r"(Expand|Generate explode|HashAggregate|Exchange hashpartitioning)", plan)
    first_exchange = len(top_down) - 1 - top_down[::-1].index("Exchange hashpartitioning")
    assert "Expand" in top_down[:first_exchange]
    aggregates = [i for i, x in enumerate(top_down) if x == "HashAggregate"]
    assert any(i > top_down.index("Expand") for i in aggregates)


def test_relation_checks_read_each_table_once(static_plans):
    # requests, delivery and verification: one scan each
    assert static_plans["quality_relations"].count("FileScan") == 3
