"""Invariants on generated data, at sf0.01."""

import pytest
from pyspark.sql import functions as F

from cadence import schemas
from cadence.plans import pipeline
from cadence.plans.catalog import ORACLE_PARAMS as P
from cadence.plans.catalog import inputs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def frames(spark):
    inp = inputs(spark, SF)
    f = pipeline.daily_frames(inp, P)
    sess = pipeline.sessions_aggregated(inp, P)
    return {
        **f,
        "sessions_aggregated": sess,
        "people_aggregated": pipeline.people_aggregated(sess, P),
        "user_daily_activity": pipeline.user_daily_activity(f, P),
        "user_churn_state": pipeline.user_churn_state(f["in_range"], P),
    }


@pytest.mark.parametrize("table", list(schemas.OUTPUTS))
def test_output_schema_exact(frames, table):
    got = [(f.name, f.dataType) for f in frames[table].schema.fields]
    want = [(f.name, f.dataType) for f in schemas.OUTPUTS[table].fields]
    assert got == want


def test_grid_has_one_row_per_day_in_range(frames):
    per_user = frames["user_daily_activity"].groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"))
    bad = (per_user.join(frames["ranges"].select("user_id", "start_date"), "user_id")
           .where((F.col("n") != F.datediff(F.lit(P.end_date), "start_date") + 1)
                  | (F.col("lo") != F.col("start_date")) | (F.col("hi") != F.lit(P.end_date))))
    assert bad.count() == 0
    assert frames["user_daily_activity"].select("user_id", "date").distinct().count() == \
        frames["user_daily_activity"].count()


def test_grid_totals_equal_in_range_activity(frames):
    cols = schemas.ACTIVITY_COUNTS
    grid = frames["user_daily_activity"].agg(*[F.sum(c).alias(c) for c in cols]).collect()[0]
    sparse = frames["in_range"].agg(*[F.sum(c).alias(c) for c in cols]).collect()[0]
    assert tuple(grid) == tuple(sparse)
    assert grid["event_count"] > 0


def test_churn_state_consistency(frames):
    c = frames["user_churn_state"]
    thr = P.threshold_days
    for k in ("app", "biz"):
        state, first, last = f"{k}_churn_state", f"first_{k}_active_date", f"last_{k}_active_date"
        times, since, cdate = f"{k}_times_churned", f"days_since_last_{k}_activity", f"{k}_churn_date"
        checks = {
            "first<=last<=end": F.col(first).isNotNull() & ~((F.col(first) <= F.col(last))
                                                           & (F.col(last) <= F.lit(P.end_date))),
            "active has no gaps": (F.col(state) == "active") & (F.col(times) != 0),
            "reactivated has gaps": (F.col(state) == "reactivated") & (F.col(times) == 0),
            "churned beyond threshold": (F.col(state) == "churned")
            & ~((F.col(since) > thr) & (F.col(cdate) == F.date_add(F.col(last), thr))),
            "not churned has no churn date": (F.col(state) != "churned") & F.col(cdate).isNotNull(),
            "never active is empty": (F.col(state) == "never_active")
            & (F.col(first).isNotNull() | (F.col(times) != 0) | F.col(since).isNotNull()),
        }
        for name, bad in checks.items():
            assert c.where(bad).count() == 0, f"{k}: {name}"
    both_never = (F.col("app_churn_state") == "never_active") & (F.col("biz_churn_state") == "never_active")
    assert c.where(both_never).count() == 0
    states = {r[0] for r in c.select("app_churn_state").distinct().collect()}
    assert states == {"active", "reactivated", "churned", "never_active"}


def test_people_counts_match_sessions(frames):
    s = frames["sessions_aggregated"]
    p = frames["people_aggregated"]
    assert p.agg(F.sum("total_sessions")).collect()[0][0] == s.count()
    assert p.select("user_id").distinct().count() == s.select("user_id").distinct().count()
