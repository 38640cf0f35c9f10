"""Daily activity and churn on the golden fixture (FIXTURES.md section 3)."""

import datetime as dt

from fixtures import END_DATE, golden as make_golden
from cadence.operators import activity, churn

D = dt.date


def _daily(g, end=END_DATE):
    return activity.build(g["product_events"], g["app_events"], g["invites"], g["users"],
                          g["excluded"], end)


def test_grid_row_counts(golden):
    daily = _daily(golden)["daily"]
    counts = {r.user_id: r.n for r in daily.groupBy("user_id").count().withColumnRenamed("count", "n").collect()}
    assert counts == {"u1": 40, "u2": 40, "u9": 22}


def test_grid_nonzero_rows(golden):
    daily = _daily(golden)["daily"]
    rows = daily.where("event_count + events_created_count + accepted + invited + rejected > 0").collect()
    got = sorted((r.user_id, r.date, r.event_count, r.events_created_count, r.accepted, r.invited, r.rejected)
                 for r in rows)
    assert got == [
        ("u1", D(2024, 1, 3), 3, 1, 1, 1, 0),
        ("u1", D(2024, 1, 6), 1, 0, 0, 0, 0),
        ("u1", D(2024, 1, 25), 1, 0, 0, 0, 0),
        ("u2", D(2024, 1, 5), 1, 0, 0, 0, 0),
        ("u2", D(2024, 1, 7), 1, 0, 0, 0, 0),
        ("u9", D(2024, 1, 20), 0, 1, 0, 0, 0),
    ]


def test_created_at_on_every_row(golden):
    daily = _daily(golden)["daily"]
    u1 = daily.where("user_id = 'u1'").select("createdAt", "phoneNumber", "fullName").distinct().collect()
    assert len(u1) == 1 and u1[0].createdAt == dt.datetime(2024, 1, 2, 8, 0) and u1[0].fullName == "Ann"
    u9 = daily.where("user_id = 'u9'").select("createdAt", "phoneNumber").distinct().collect()
    assert [tuple(r) for r in u9] == [(None, None)]


def _churn(g, end=END_DATE, thr=14, from_grid=False):
    frames = _daily(g, end)
    src = frames["daily"] if from_grid else frames["in_range"]
    return {r.user_id: r for r in churn.churn_state(src, end, thr).collect()}


def test_churn_end_state(golden):
    for from_grid in (False, True):
        c = _churn(golden, from_grid=from_grid)
        assert set(c) == {"u1", "u2", "u9"}
        u1, u2, u9 = c["u1"], c["u2"], c["u9"]
        assert (u1.app_churn_state, u1.app_churn_date, u1.app_times_churned,
                u1.days_since_last_app_activity) == ("churned", D(2024, 2, 8), 1, 16)
        assert (u1.biz_churn_state, u1.biz_churn_date, u1.biz_times_churned,
                u1.days_since_last_biz_activity) == ("churned", D(2024, 1, 17), 0, 38)
        assert (u1.total_events_created, u1.total_events_attended, u1.total_app_interactions) == (1, 1, 5)
        assert (u2.app_churn_state, u2.app_churn_date, u2.app_times_churned,
                u2.days_since_last_app_activity) == ("churned", D(2024, 1, 21), 0, 34)
        assert (u2.biz_churn_state, u2.biz_churn_date, u2.biz_times_churned,
                u2.days_since_last_biz_activity) == ("never_active", None, 0, None)
        assert (u2.total_events_created, u2.total_events_attended, u2.total_app_interactions) == (0, 0, 2)
        assert (u9.app_churn_state, u9.app_times_churned, u9.days_since_last_app_activity) == \
            ("never_active", 0, None)
        assert (u9.biz_churn_state, u9.biz_churn_date, u9.days_since_last_biz_activity) == \
            ("churned", D(2024, 2, 3), 21)


def test_churn_other_end_dates(golden):
    c = _churn(golden, end=D(2024, 2, 8))
    assert (c["u1"].app_churn_state, c["u1"].days_since_last_app_activity) == ("reactivated", 14)
    c = _churn(golden, end=D(2024, 2, 1))
    assert (c["u1"].app_churn_state, c["u1"].days_since_last_app_activity) == ("reactivated", 7)
    assert (c["u9"].biz_churn_state, c["u9"].days_since_last_biz_activity) == ("active", 12)


def test_excluded_person_removed_after_canonicalisation(golden):
    daily = _daily(golden)["daily"]
    assert daily.where("user_id in ('u3', 'u3b')").count() == 0


def test_invite_pivot_only_accepted(spark):
    g = make_golden(spark, invites=[("u1", dt.datetime(2024, 1, 3), "accepted")])
    row = _daily(g)["daily"].where("user_id = 'u1' and date = '2024-01-03'").collect()[0]
    assert (row.accepted, row.invited, row.rejected) == (1, 0, 0)
