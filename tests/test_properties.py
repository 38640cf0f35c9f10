"""Property tests against brute force, including a hot key holding a third of rows."""

import datetime as dt
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from cadence.functions.stats import exact_median, ordered_long
from cadence.operators import churn, sessions

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

users = st.sampled_from(["hot", "hot", "hot", "a", "b", "c"])  # "hot" holds about half
minute = st.integers(min_value=0, max_value=4 * 24 * 60)


@SETTINGS
@given(ivs=st.lists(st.tuples(users, minute, st.integers(0, 600)), min_size=1, max_size=40),
       evs=st.lists(st.tuples(users, minute), max_size=60))
def test_created_during_equals_brute_force(spark, ivs, evs):
    iv_rows = [(u, T0 + dt.timedelta(minutes=s), T0 + dt.timedelta(minutes=s + d)) for u, s, d in ivs]
    ev_rows = [(u, T0 + dt.timedelta(minutes=m)) for u, m in evs]
    iv = spark.createDataFrame(iv_rows, "user_id string, start_timestamp timestamp, end_timestamp timestamp")
    ev = spark.createDataFrame(ev_rows, "user_id string, createdAt timestamp")
    got = {(r.user_id, r.start_timestamp, r.end_timestamp): r.created_event
           for r in sessions.created_during(iv, ev).collect()}
    want = {(u, s, e): any(eu == u and s <= t <= e for eu, t in ev_rows) for u, s, e in iv_rows}
    assert got == want


@SETTINGS
@given(vals=st.lists(st.tuples(users, st.one_of(st.none(), st.integers(0, 50).map(float))), min_size=1,
                     max_size=60))
def test_exact_median_equals_statistics_median(spark, vals):
    df = spark.createDataFrame(vals, "k string, v double")
    got = {r.k: r.m for r in exact_median(df, "k", "v", "m").collect()}
    want = {}
    for k in {k for k, _ in vals}:
        xs = [v for kk, v in vals if kk == k and v is not None]
        if xs:
            want[k] = float(statistics.median(xs))
    assert got == want


def _brute_churn(rows, end, thr):
    out = {}
    by_user = {}
    for u, d, ec, cr, acc in rows:
        by_user.setdefault(u, []).append((d, ec, cr, acc))
    for u, days in by_user.items():
        res = {}
        for kind, pred in (("app", lambda r: r[1] > 0), ("biz", lambda r: r[2] + r[3] > 0)):
            act = sorted(r[0] for r in days if pred(r))
            if not act:
                res[kind] = ("never_active", 0)
                continue
            gaps = sum(1 for a, b in zip(act, act[1:]) if (b - a).days > thr)
            since = (end - act[-1]).days
            state = "churned" if since > thr else ("reactivated" if gaps else "active")
            res[kind] = (state, gaps)
        if res["app"][0] != "never_active" or res["biz"][0] != "never_active":
            out[u] = res
    return out


@SETTINGS
@given(rows=st.lists(st.tuples(users, st.integers(0, 60), st.integers(0, 2), st.integers(0, 1),
                               st.integers(0, 1)), max_size=80, unique_by=lambda r: (r[0], r[1])),
       thr=st.integers(1, 10))
def test_churn_equals_brute_force(spark, rows, thr):
    end = dt.date(2024, 3, 1)
    data = [(u, dt.date(2024, 1, 1) + dt.timedelta(days=d), ec, cr, acc) for u, d, ec, cr, acc in rows]
    df = spark.createDataFrame(
        [(u, d, ec, cr, acc, 0, 0) for u, d, ec, cr, acc in data],
        "user_id string, date date, event_count long, events_created_count long, accepted long, "
        "invited long, rejected long")
    got = {r.user_id: {"app": (r.app_churn_state, r.app_times_churned),
                       "biz": (r.biz_churn_state, r.biz_times_churned)}
           for r in churn.churn_state(df, end, thr).collect()}
    assert got == _brute_churn(data, end, thr)


@SETTINGS
@given(vals=st.lists(st.tuples(users, st.one_of(st.none(), st.sampled_from([0.0, 0.5, 1.25, 7.0, 1e6]),
                                                 st.floats(0, 100, allow_nan=False))),
                     min_size=1, max_size=60))
def test_exact_median_with_digits_of_other_sizes(spark, vals):
    """Short prefixes leave the choice to the digits, long ones to the prefix."""
    df = spark.createDataFrame(vals, "k string, v double")
    got = {r.k: r.m for r in exact_median(df, "k", "v", "m", **(dict(steps=3, digit=2) if len(vals) % 2 else dict(steps=1 << 40, digit=30))).collect()}
    want = {}
    for k in {k for k, _ in vals}:
        xs = sorted(v for kk, v in vals if kk == k and v is not None)
        if xs:
            n = len(xs)
            want[k] = (xs[(n + 1) // 2 - 1] + xs[n // 2]) / 2
    assert got == want


@SETTINGS
@given(vals=st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=1, max_size=60))
def test_ordered_long_keeps_the_order_of_doubles(spark, vals):
    vals = sorted({v + 0.0 for v in vals + [0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.0, 0.1, 1.0, 2.0]},
                  key=lambda v: (v != v, v))
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(vals)], "v double, i int")
    got = [r[0] for r in df.select(ordered_long(F.col("v")), "i").orderBy("i").collect()]
    assert got == sorted(got) and len(set(got)) > 4
