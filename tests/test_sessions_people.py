"""Sessions and people on the golden fixture (FIXTURES.md section 3)."""

import datetime as dt

import pytest

from fixtures import RN, RUN_TS
from cadence import schemas
from cadence.functions.conform import conform
from cadence.operators import people, sessions


@pytest.fixture(scope="module")
def sess(golden):
    df = sessions.sessions_aggregated(golden["product_events"], golden["sessions"], golden["users"],
                                      golden["app_events"], golden["excluded"], RN)
    return conform(df, schemas.SESSIONS_AGGREGATED, RUN_TS)


def test_sessions_rows(sess):
    rows = {r.session_id: r for r in sess.collect()}
    assert set(rows) == {"s1", "s4", "s5", "s6", "s10"}
    s1 = rows["s1"]
    assert s1.user_id == "u1" and s1.city == "Austin" and s1.country == "US"
    assert s1.scroll_event_count == 2 and s1.session_duration == 360.0
    true_flags = {f for f in schemas.SESSION_FLAGS + ["started_quiz", "completed_quiz"] if s1[f]}
    assert true_flags == {"created_event", "viewed_event", "joined_event", "scrolled", "visited_discover"}
    assert rows["s4"].user_id == "u1" and rows["s4"].viewed_event and rows["s4"].session_duration == 0.0
    assert rows["s5"].user_id == "u2" and rows["s5"].completed_quiz and rows["s5"].session_duration is None
    assert rows["s6"].user_id == "u3b" and rows["s6"].session_duration == 10.0
    assert rows["s10"].user_id == "u4" and rows["s10"].viewed_event
    for r in rows.values():
        assert r.contactAccessGranted is False and r.businessUser is False
        assert r.etl_loaded_at == RUN_TS
    assert sess.columns == schemas.SESSIONS_AGGREGATED.fieldNames()


def test_people_rows(sess):
    p = {r.user_id: r for r in people.people_aggregated(sess).collect()}
    assert set(p) == {"u1", "u2", "u3b", "u4"}
    u1 = p["u1"]
    assert u1.total_sessions == 2
    assert (u1.avg_session_duration, u1.median_session_duration, u1.total_session_duration) == (180, 180, 360)
    assert u1.std_session_duration == pytest.approx(254.558441, abs=1e-6)
    assert u1.days_since_first_session == pytest.approx(2.041667, abs=1e-6)
    assert u1.sessions_per_day == pytest.approx(0.657534, abs=1e-6)
    assert u1.engagement_score == 2.5
    u2 = p["u2"]
    assert (u2.total_sessions, u2.avg_session_duration, u2.median_session_duration,
            u2.total_session_duration, u2.std_session_duration) == (1, None, None, 0.0, None)
    assert (u2.days_since_first_session, u2.sessions_per_day, u2.engagement_score) == (None, None, 0.0)
    u3b = p["u3b"]
    assert (u3b.avg_session_duration, u3b.median_session_duration, u3b.total_session_duration) == (10, 10, 10)
    assert (u3b.std_session_duration, u3b.days_since_first_session, u3b.sessions_per_day,
            u3b.engagement_score) == (None, 0.0, 1.0, 1.0)
    u4 = p["u4"]
    assert (u4.days_since_first_session, u4.engagement_score) == (None, 1.0)


def test_null_distinct_id_kept_by_exclusion(spark):
    from fixtures import golden as make_golden, props, ts
    g = make_golden(spark, product_events=[("view_event", None, ts("2024-01-03 10:00"), props(RN, "sx"))])
    ev = sessions.extract_events(g["product_events"], g["excluded"], RN)
    assert ev.count() == 1


def test_duplicate_json_key_last_wins(spark):
    from fixtures import golden as make_golden, ts
    g = make_golden(spark, product_events=[
        ("view_event", "u2", ts("2024-01-03 10:00"),
         '{"$lib": "web", "$lib": "%s", "$session_id": "sx"}' % RN)])
    ev = sessions.extract_events(g["product_events"], g["excluded"], RN)
    assert ev.count() == 1


def test_created_during_inclusive_bounds(spark):
    iv = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)),
                                ("a", dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 1)),
                                ("a", dt.datetime(2024, 1, 3, 0), dt.datetime(2024, 1, 3, 1)),
                                ("b", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10))],
                               "user_id string, start_timestamp timestamp, end_timestamp timestamp")
    ev = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 11)), ("a", dt.datetime(2024, 1, 2, 1)),
                                ("a", dt.datetime(2024, 1, 2, 23)), ("b", dt.datetime(2024, 1, 1, 10)),
                                ("c", dt.datetime(2024, 1, 1, 10))],
                               "user_id string, createdAt timestamp")
    got = {(r.user_id, r.start_timestamp.day, r.start_timestamp.hour): r.created_event
           for r in sessions.created_during(iv, ev).collect()}
    assert got == {("a", 1, 10): True, ("a", 1, 12): True, ("a", 3, 0): False, ("b", 1, 10): True}


def test_created_flag_of_each_row(spark):
    """J4 row by row: an event in a later hour, at either end, none, null edges and users, equal rows."""
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    ev = spark.createDataFrame([("u", at(5, 30)), ("u", at(9)), ("u", None), (None, at(5)), ("w", at(1))], "user_id string, createdAt timestamp")
    rows = [("a", "u", at(1), at(5, 30), True), ("b", "u", at(5, 30), at(5, 30), True), ("c", "u", at(5, 31), at(8, 59), False),
            ("d", "u", at(5, 31), at(9), True), ("e", "u", at(9, 1), at(12), False), ("f", "u", at(9), at(5), False),
            ("g", "u", None, at(12), False), ("h", "u", at(1), None, False), ("i", None, at(1), at(12), False),
            ("j", "v", at(1), at(12), False), ("k", "u", at(1), at(5, 30), True), ("k", "u", at(1), at(5, 30), True)]
    held = "session_id string, user_id string, start_timestamp timestamp, end_timestamp timestamp"
    got = sessions.with_created(spark.createDataFrame([r[:4] for r in rows], held), ev)
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame(rows, held + ", created_event boolean").collect()))
