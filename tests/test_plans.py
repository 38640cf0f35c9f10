"""Plan checks: built-ins only, no pairwise joins, pruned scans, pushed filters."""

import re
import tempfile

import pytest

from cadence.plans.catalog import QUERIES, ORACLE_PARAMS
from cadence.plans.pipeline import Inputs
from cadence.sources import adapters, readers

SF = "/root/testdata/sf0.001"
HEADLINE = ["sessions_aggregated", "people_aggregated", "user_daily_activity", "user_churn_state",
            "session_created_event", "activity_spine"]
FORBIDDEN = ["PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin", "collect_list", "collect_set", "percentile(",
             "LocalTableScan"]


@pytest.fixture(scope="module")
def materialized(spark):
    out = tempfile.mkdtemp(prefix="cadence-plans-")
    return adapters.materialize(spark, SF, out)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEADLINE)
def test_no_slow_or_pairwise_operators(spark, materialized, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plan contains {bad}"


def test_product_event_scan_is_pruned_and_filtered(spark, materialized):
    ev = readers.read_inputs(spark, materialized, since=ORACLE_PARAMS.since)["product_events"]
    plan = _plan(ev.select("distinct_id", "timestamp"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp", plan), plan
    assert "ReadSchema: struct<distinct_id:string,timestamp:timestamp>" in plan, plan


def test_sessions_scan_reads_only_needed_columns(spark, materialized):
    plan = _plan(QUERIES["session_metadata_join"](spark, SF))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    users_like = [s for s in scans if "fullName" in s]
    assert not users_like, "metadata join must not read users"


def test_grid_is_not_shuffled(spark, materialized):
    """The dense grid is expanded from frames partitioned by user_id: above it stand no
    exchange and no join, and nothing is joined on (user_id, date) or built into a hash table by hint."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(QUERIES["user_daily_activity"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above = plan.split("Generate explode")[0]
    assert "Exchange" not in above and "Join" not in above, above
    assert "ShuffledHashJoin" not in plan
    joins = re.findall(r"(?:SortMergeJoin|HashJoin) \[([^\]]*)\]", plan)
    assert joins and not any("date#" in keys for keys in joins)


def test_keep_first_is_an_aggregate_not_a_window(spark, materialized):
    from cadence.operators import identity
    users = Inputs.of(adapters.load_inputs(spark, SF)).users
    plan = _plan(identity.user_lookup(users))
    assert "Window" not in plan and "row_number" not in plan
