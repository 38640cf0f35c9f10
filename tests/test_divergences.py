"""Divergence register: one test per kept or fixed behaviour
that the golden fixture does not already cover."""

import datetime as dt

from fixtures import RN, END_DATE, golden as make_golden, props, ts
from cadence.operators import activity, identity, sessions


def _sessions(g):
    return sessions.sessions_aggregated(g["product_events"], g["sessions"], g["users"],
                                        g["app_events"], g["excluded"], RN)


def _user(uid, name, phone, username=None, email=None, created=None):
    return (uid, name, phone, username, email, None, None, created)


def test_d1_null_distinct_id_matches_no_user(spark):
    # pandas would match a null distinct_id to the user with a null phone.
    g = make_golden(spark, users=[_user("u2", "Bo", None)],
                    product_events=[("view_event", None, ts("2024-01-03 10:00"), props(RN, "sx"))])
    assert _sessions(g).count() == 0


def test_d5_shared_phone_under_two_names_fans_out(spark):
    g = make_golden(spark, users=[_user("ua", "Ann", "+15550009"), _user("ub", "Bea", "+15550009")],
                    product_events=[("view_event", "+15550009", ts("2024-01-03 10:00"), props(RN, "sx"))])
    rows = _sessions(g).collect()
    assert sorted(r.user_id for r in rows) == ["ua", "ub"]
    assert {r.session_id for r in rows} == {"sx"}


def test_d6_null_name_and_phone_collapse(spark):
    # W1 keeps one of the users whose name and phone are both null (uX by
    # user_id), so a session by uY's id finds no user.
    g = make_golden(spark, users=[_user("uX", None, None), _user("uY", None, None)],
                    product_events=[("view_event", "uY", ts("2024-01-03 10:00"), props(RN, "sy")),
                                    ("view_event", "uX", ts("2024-01-03 11:00"), props(RN, "sx"))])
    assert [r.session_id for r in _sessions(g).collect()] == ["sx"]


def test_d11_user_with_two_phones_does_not_multiply_rows(spark):
    users = [_user("u7", "Gil", "+15550071", "gil", "g@x", ts("2024-02-01")),
             _user("u7", "Gil", "+15550072", "gil", "g@x", ts("2024-02-01"))]
    ev = [("view_event", "+15550071", ts("2024-02-03 10:00"), props(RN, "s1")),
          ("view_event", "+15550072", ts("2024-02-03 11:00"), props(RN, "s2"))]
    g = make_golden(spark, users=users, product_events=ev, app_events=[], invites=[])
    f = activity.build(g["product_events"], g["app_events"], g["invites"], g["users"], g["excluded"], END_DATE)
    daily = f["daily"].collect()
    assert len(daily) == 10  # 2024-02-01 .. 2024-02-10, once each
    assert [r.event_count for r in daily if r.date == dt.date(2024, 2, 3)] == [2]
    # both phones map to the one user id
    pm = {r.phoneNumber: r.user_id for r in identity.phone_map(identity.user_lookup(g["users"])).collect()}
    assert pm == {"+15550071": "u7", "+15550072": "u7"}


def test_d15_first_values_follow_event_time_not_input_order(spark):
    ev = [("view_event", "+15550001", ts("2024-01-03 10:05"), props(RN, "s1", city="Later")),
          ("view_event", "+15550001", ts("2024-01-03 10:00"), props(RN, "s1", city="First"))]
    g = make_golden(spark, product_events=ev)
    assert [r.city for r in _sessions(g).collect()] == ["First"]
    g2 = make_golden(spark, product_events=list(reversed(ev)))
    assert [r.city for r in _sessions(g2).collect()] == ["First"]


def test_d16_malformed_json_is_dropped_not_fatal(spark):
    ev = [("view_event", "+15550001", ts("2024-01-03 10:00"), "{broken"),
          ("view_event", "+15550001", ts("2024-01-03 10:01"), None),
          ("view_event", "+15550001", ts("2024-01-03 10:02"), "[1, 2]"),
          ("view_event", "+15550001", ts("2024-01-03 10:03"), props(RN, "s1"))]
    g = make_golden(spark, product_events=ev)
    assert sessions.extract_events(g["product_events"], g["excluded"], RN).count() == 1


def test_d22_each_touch_axis_counts(spark):
    ev = [("view_event", "+15550001", ts("2024-01-03 10:00"), props(RN, "s1", touch_x=3, touch_y=4)),
          ("view_event", "+15550001", ts("2024-01-03 10:01"), props(RN, "s1", touch_x=None, touch_y=5))]
    g = make_golden(spark, product_events=ev)
    b = sessions.session_behaviour(sessions.extract_events(g["product_events"], g["excluded"], RN)).collect()
    assert [(r.scroll_event_count, r.scrolled) for r in b] == [(3, True)]


def test_d2_excluded_list_keeps_null_ids(spark):
    g = make_golden(spark, product_events=[
        ("view_event", None, ts("2024-01-03 10:00"), props(RN, "s1")),
        ("view_event", "+15550003", ts("2024-01-03 10:00"), props(RN, "s2"))])
    got = [r.session_id for r in sessions.extract_events(g["product_events"], g["excluded"], RN).collect()]
    assert got == ["s1"]


def test_d10_activity_outside_grid_dropped(spark):
    g = make_golden(spark)
    f = activity.build(g["product_events"], g["app_events"], g["invites"], g["users"], g["excluded"], END_DATE)
    # u1's 2024-01-01 event is before createdAt (2024-01-02): in the spine, not in the grid.
    assert f["spine"].where("user_id = 'u1' AND date = '2024-01-01'").count() == 1
    assert f["daily"].where("user_id = 'u1' AND date = '2024-01-01'").count() == 0
    assert f["in_range"].where("user_id = 'u1' AND date = '2024-01-01'").count() == 0
