"""A hot key: one phone owns a third of all product events. Results must stay
exact (oracle match), and the per-user work stays aggregate-based."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from cadence.functions import stats
from cadence.operators import sessions
from cadence.sources import adapters

SF = "/root/testdata/sf0.01"
HOT = "'+15550000001'"
QUERIES_TO_CHECK = ["sessions_aggregated", "people_aggregated", "activity_spine", "user_daily_activity",
                    "user_churn_state", "session_created_event"]


@pytest.fixture()
def skewed(monkeypatch):
    # Every third event is re-attributed to one phone (one user), before the
    # usual id rotation; both engines derive their inputs from this text.
    monkeypatch.setattr(adapters, "_DISTINCT_ID", f"CASE WHEN event_id % 3 = 0 THEN {HOT} ELSE "
                        f"({adapters._DISTINCT_ID}) END")
    monkeypatch.setattr(adapters, "_MATERIALIZED", {})
    yield


@pytest.mark.parametrize("name", QUERIES_TO_CHECK)
def test_hot_phone_results_exact(spark, skewed, name):
    import __spark_entry__ as E
    con = duck(SF)
    ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert ok, msg


def test_hot_phone_really_is_hot(spark, skewed):
    ev = adapters.load_inputs(spark, SF)["product_events"]
    total = ev.count()
    hot = ev.where(f"distinct_id = {HOT}").count()
    assert hot >= total / 3


def _largest_share(df, key):
    """Rows of the largest partition of a frame, of all."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_median_of_a_hot_user_is_counted_in_many_tasks(spark):
    """A user with a third of all rows: the counts of their values are spread over the tasks, by
    value and by prefix and digit, and the median is exact."""
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 500).cast("string"))).alias("u"),
                                      (F.pmod(F.xxhash64("id"), F.lit(10_000_000)) / 7).alias("v"))
    plan = stats.exact_median(rows, "u", "v", "m")._jdf.queryExecution().executedPlan().toString()
    names = {re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)}
    assert {"u, v", "u, _fine", "u, _lead"} <= names, names
    counts = rows.groupBy("u", "v").count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _largest_share(counts, "u") < 0.2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {r["u"]: r["m"] for r in stats.exact_median(rows, "u", "v", "m").collect()}
    want = {r["u"]: r["m"] for r in rows.groupBy("u").agg(F.median("v").alias("m")).collect()}
    assert got == want


def test_a_session_until_the_year_9999_costs_two_rows(spark):
    """Equal edges count, a long interval is as dear as a short one."""
    day = lambda y, d=1, h=0: dt.datetime(y, 1, d, h)
    iv = [("a", day(2024), day(9999)), ("a", day(1900), day(2024, 1)), ("a", day(2024, 2), day(9999)), ("b", day(1900), day(9999)),
          ("c", day(2024, 3, 5), day(2024, 3, 5)), ("c", day(2024, 3, 6), day(2024, 3, 7))] + [("a", day(2024, 2), day(9999))] * 3
    ev = [("a", day(2024)), ("a", day(2024)), ("c", day(2024, 3, 5)), ("d", day(2024))]
    iv_df = spark.createDataFrame(iv, "user_id string, start_timestamp timestamp, end_timestamp timestamp")
    ev_df = spark.createDataFrame(ev, "user_id string, createdAt timestamp")
    got = {tuple(r)[:3]: r["created_event"] for r in sessions.created_during(iv_df, ev_df).collect()}
    assert got == {(u, s, e): any(u == x and s <= t <= e for x, t in ev) for u, s, e in iv}
    plan = sessions.created_during(iv_df, ev_df)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan
