"""Sinks (S7-S10) and the job runner (two branches, stage isolation)."""

import dataclasses
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from oracle_compare import normalise
from cadence import schemas
from cadence.functions.conform import conform
from cadence.plans import job
from cadence.plans.catalog import ORACLE_PARAMS, QUERIES, round_floats
from cadence.plans.pipeline import Inputs
from cadence.session import scratch_path
from cadence.sources import adapters, readers, sinks

SF = "/root/testdata/sf0.001"
FULL = dataclasses.replace(ORACLE_PARAMS, since=None)


def _rows(df):
    return normalise(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def sources(spark):
    return adapters.materialize(spark, SF, tempfile.mkdtemp(prefix="cadence-job-"))


def test_overwrite_append_and_counts(spark):
    target = scratch_path(spark, "sink")
    df = spark.range(5).selectExpr("CAST(id AS STRING) AS user_id")
    r1 = sinks.write_table(df, target, "overwrite")
    r2 = sinks.write_table(df, target, "append")
    assert (r1.rows_written, r2.rows_written) == (5, 5)
    assert (r1.table_rows, r2.table_rows) == (5, 10)
    assert sinks.read_back(spark, target).count() == 10
    sinks.write_table(df.limit(2), target, "overwrite")
    assert sinks.read_back(spark, target).count() == 2


def test_empty_frame_leaves_table(spark):
    target = scratch_path(spark, "sink")
    df = spark.range(3).selectExpr("CAST(id AS STRING) AS user_id")
    sinks.write_table(df, target, "overwrite")
    res = sinks.write_table(df.where(F.lit(False)), target, "overwrite")
    assert res.skipped and res.rows_written == 0
    assert sinks.read_back(spark, target).count() == 3


def test_required_null_fails_the_write(spark):
    target = scratch_path(spark, "sink")
    df = conform(spark.createDataFrame([(None,)], "user_id string"), schemas.USER_CHURN_STATE)
    with pytest.raises(Exception):
        sinks.write_table(df, target, "overwrite", schema=schemas.USER_CHURN_STATE)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_failed_overwrite_keeps_the_old_table(spark, kind):
    target = scratch_path(spark, "sink")
    if kind == "table":
        sinks.ensure_database(spark, "cadence_test_db")
        target = "cadence_test_db.t_" + target.rsplit("-", 1)[1]
    good = conform(spark.createDataFrame([("a",), ("b",), ("c",)], "user_id string"), schemas.USER_CHURN_STATE)
    bad = conform(spark.createDataFrame([("a",), (None,)], "user_id string"), schemas.USER_CHURN_STATE)
    sinks.write_table(good, target, "overwrite")
    with pytest.raises(Exception, match="REQUIRED"):
        sinks.write_table(bad, target, "overwrite", schema=schemas.USER_CHURN_STATE)
    assert sinks.read_back(spark, target).count() == 3


@pytest.mark.parametrize("kind", ["path", "table"])
@pytest.mark.parametrize("point", ["rows", "files", "switch"])
def test_a_failure_at_any_point_leaves_the_old_table(spark, monkeypatch, kind, point):
    """While a version is computed, after its files are written, and in the step that publishes it."""
    target = scratch_path(spark, "publish")
    if kind == "table":
        sinks.ensure_database(spark, "cadence_test_db")
        target = "cadence_test_db.p_" + target.rsplit("-", 1)[1]
    rows = lambda n: spark.range(n).selectExpr("CAST(id AS STRING) AS user_id")
    kept = lambda: sinks.read_back(spark, target).count()
    for n in range(1, sinks.SLOTS + 3):   # the slots go round
        sinks.write_table(rows(n), target, "overwrite")
        assert kept() == n

    def fail(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        bad = rows(9)
        if point == "rows":
            bad = bad.withColumn("user_id", F.when(F.col("user_id") == "8", F.raise_error(F.lit("lost"))).otherwise(F.col("user_id")))
        elif point == "files":
            m.setattr(sinks, "_publish", fail)
        else:
            m.setattr(type(spark.range(1).write), "parquet", fail)
            m.setattr(type(spark), "sql", lambda self, q, *a, f=type(spark).sql, **k: fail() if "SET LOCATION" in q else f(self, q, *a, **k))
        with pytest.raises(Exception, match="lost"):
            sinks.write_table(bad, target, "overwrite")
    assert kept() == n
    sinks.write_table(rows(7), target, "overwrite")
    assert kept() == 7


def test_plain_files_are_a_table_until_they_are_overwritten(spark):
    target = scratch_path(spark, "plain")
    assert not sinks.exists(spark, target)
    df = spark.range(4).selectExpr("CAST(id AS STRING) AS user_id")
    df.write.parquet(target)
    assert sinks.exists(spark, target) and sinks.read_back(spark, target).count() == 4
    assert sinks.write_table(df, target, "append").table_rows == 8
    sinks.write_table(df.limit(3).withColumn("n", F.lit(1)), target, "overwrite", partition_by=["user_id"])
    assert sinks.read_back(spark, target).count() == 3


def test_timestamps_without_a_zone_are_utc(spark, monkeypatch):
    import datetime as dt
    import time
    from cadence.functions.conform import stamp
    try:
        monkeypatch.setenv("TZ", "America/New_York")
        time.tzset()
        at = dt.datetime(2024, 1, 15)
        got = stamp(spark.range(1), at).select(F.col("etl_loaded_at").cast("long")).first()[0]
        kept = readers.since_filter(spark.sql("SELECT timestamp_seconds(1705276800) AS timestamp"), at).count()
    finally:
        monkeypatch.undo()
        time.tzset()
    assert got == 1705276800 and kept == 1


def test_catalog_table_and_database(spark):
    sinks.ensure_database(spark, "cadence_test_db")
    sinks.ensure_database(spark, "cadence_test_db")  # idempotent
    df = spark.range(4).selectExpr("CAST(id AS STRING) AS user_id")
    res = sinks.write_table(df, "cadence_test_db.t_overwrite", "overwrite")
    assert res.rows_written == 4 and spark.read.table("cadence_test_db.t_overwrite").count() == 4


def test_since_and_limit_readers(spark, sources):
    ev = readers.read_inputs(spark, sources, since=ORACLE_PARAMS.since)["product_events"]
    assert ev.where(F.col("timestamp") < F.lit(ORACLE_PARAMS.since)).count() == 0
    capped = readers.read_inputs(spark, sources, limit=7)
    assert all(df.count() <= 7 for df in capped.values())
    ordered = readers.cap_rows(capped["users"], 3, ["user_id"])
    assert [r.user_id for r in ordered.collect()] == sorted(r.user_id for r in capped["users"].collect())[:3]


def test_job_writes_four_tables_equal_to_queries(spark, sources):
    out = tempfile.mkdtemp(prefix="cadence-out-")
    results = job.run(spark, sources, out, FULL)
    assert [r.status for r in results] == ["ok"] * 4, results
    ev = spark.read.parquet(sources["product_events"])
    metrics = results[0].metrics
    assert metrics["events_read"] == ev.count()
    assert metrics["malformed_properties"] == ev.where("properties = 'not json'").count() > 0
    sess = sinks.read_back(spark, f"{out}/sessions_aggregated")
    fan = sess.groupBy("session_id").count().where("count > 1").count()
    assert metrics["sessions_with_several_users"] == fan
    for r in results:
        got = sinks.read_back(spark, f"{out}/{r.table}")
        assert got.columns == schemas.OUTPUTS[r.table].fieldNames()
        assert got.count() == r.rows
    # same rows as the registered (lazy) queries over the same stored inputs
    # (registered queries round doubles for the oracle; the job keeps full precision)
    for table in ("sessions_aggregated", "people_aggregated", "user_daily_activity", "user_churn_state"):
        want = QUERIES[table](spark, SF)
        got = round_floats(sinks.read_back(spark, f"{out}/{table}"))
        assert _rows(got) == _rows(round_floats(want)), table


def test_failed_stage_isolated_and_reported(spark, sources):
    bad = dict(sources, sessions="/nonexistent/sessions")
    out = tempfile.mkdtemp(prefix="cadence-out-")
    with pytest.raises(Exception):
        readers.read_inputs(spark, bad)
    # A failure inside a branch: sessions fails, daily and churn still load.
    inp = Inputs.of(readers.read_inputs(spark, sources))
    boom = inp.product_events.withColumn("properties", F.raise_error(F.lit("boom")).cast("string"))
    broken = Inputs(boom, inp.sessions, inp.users, inp.app_events, inp.invites, inp.excluded)
    res = job._sessions_branch(broken, FULL, out) + job._daily_branch(inp, FULL, out)
    status = {r.table: r.status for r in res}
    assert status == {"sessions_aggregated": "failed", "people_aggregated": "skipped",
                      "user_daily_activity": "ok", "user_churn_state": "ok"}


def test_cli_main_exit_code(spark, sources, tmp_path):
    import os
    src = os.path.dirname(next(iter(sources.values())))
    rc = job.main(["--sources", src, "--target", str(tmp_path / "out"), "--end-date", "2024-01-31",
                   "--threshold", "2", "--full-load"])
    assert rc == 0
    assert sinks.read_back(spark, str(tmp_path / "out" / "user_churn_state")).count() > 0


def test_since_leaves_the_older_rows_of_stored_tables(spark, sources):
    target = scratch_path(spark, "job-since")
    old = spark.range(3).selectExpr("CAST(id AS STRING) AS user_id")
    sinks.write_table(old, f"{target}/user_churn_state", "overwrite")
    results = job.run(spark, sources, target, ORACLE_PARAMS)
    assert ORACLE_PARAMS.since and {r.status for r in results} == {"failed"} and len(results) == 4
    assert all("--since" in r.error and "user_churn_state" in r.error for r in results)
    assert sorted(r["user_id"] for r in sinks.read_back(spark, f"{target}/user_churn_state").collect()) == ["0", "1", "2"]


def test_since_with_a_history_equals_a_full_load(spark, sources, tmp_path):
    """A dated run over stored tables: events of its days are added, changed and withdrawn, one without a time stays."""
    at = F.lit(ORACLE_PARAMS.since)
    events = spark.read.parquet(sources["product_events"])
    late = F.col("timestamp") >= at
    before = str(tmp_path / "before")
    first = events.where(~late | (F.dayofmonth("timestamp") % 2 == 0)) \
        .unionByName(events.where(late).withColumn("distinct_id", F.lit("gone")).withColumn("timestamp", F.expr("timestamp + INTERVAL 2 DAYS"))) \
        .unionByName(events.where(~late).limit(5).withColumn("timestamp", F.lit(None).cast("timestamp")))
    first.write.parquet(before)
    after = str(tmp_path / "after")
    now = events.unionByName(spark.read.parquet(before).where("timestamp IS NULL"))
    now.write.parquet(after)
    target, kept = str(tmp_path / "out"), str(tmp_path / "history")
    later = dataclasses.replace(FULL, end_date=FULL.end_date + dt.timedelta(days=4))
    assert {r.status for r in job.run(spark, {**sources, "product_events": before}, target, later, history_dir=kept)} == {"ok"}
    res = job.run(spark, {**sources, "product_events": after}, target, ORACLE_PARAMS, history_dir=kept)
    assert {r.status for r in res} == {"ok"}
    full = str(tmp_path / "full")
    job.run(spark, {**sources, "product_events": after}, full, FULL)
    for table in schemas.OUTPUTS:
        assert _rows(sinks.read_back(spark, f"{target}/{table}")) == _rows(sinks.read_back(spark, f"{full}/{table}")), table
