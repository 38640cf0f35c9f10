"""The golden micro-fixture (FIXTURES.md section 2) as Spark DataFrames."""

from __future__ import annotations

import datetime as dt
import json

from cadence import schemas
from cadence.params import MOBILE_LIB

RN = MOBILE_LIB
END_DATE = dt.date(2024, 2, 10)
RUN_TS = dt.datetime(2024, 2, 10, 12, 0, 0)


def ts(s: str | None):
    if s is None:
        return None
    fmt = "%Y-%m-%d %H:%M:%S" if s.count(":") == 2 else ("%Y-%m-%d %H:%M" if ":" in s else "%Y-%m-%d")
    return dt.datetime.strptime(s, fmt)


def props(lib, sid, **kw):
    d = {"$lib": lib, "$session_id": sid}
    names = {"screen": "$screen_name", "city": "$geoip_city_name", "country": "$geoip_country_name",
             "touch_x": "$touch_x", "touch_y": "$touch_y"}
    for k, v in kw.items():
        d[names[k]] = v
    return json.dumps(d)


USERS = [
    ("u1", "Ann", "+15550001", "ann", "a@x", None, None, ts("2024-01-02 08:00")),
    ("u1b", "Ann", "+15550001", None, None, None, None, ts("2024-01-02 09:00")),
    ("u2", "Bo", None, None, None, None, None, None),
    ("u3", "Cy", "+15550003", "cy", "c@x", None, None, ts("2024-01-01 00:00")),
    ("u3b", "Cy Two", "+15550003", None, None, None, None, ts("2024-01-01 00:00")),
    ("u4", "Di", "+15550004", None, None, None, None, ts("2024-03-01 00:00")),
]

PRODUCT_EVENTS = [
    ("view_event", "+15550001", ts("2024-01-03 10:00"),
     props(RN, "s1", screen="Discover", touch_x=1, touch_y=2, city=None)),
    ("join_event", "+15550001", ts("2024-01-03 10:05"), props(RN, "s1", city="Austin", country="US")),
    ("start_quiz", "u1", ts("2024-01-03 11:00"), props("web", "s2")),
    ("Contacts_Enabled", "u1b", ts("2024-01-25 09:00"), props(RN, "s3")),
    ("view_event", "+15550001", ts("2024-01-01 09:00"), props(RN, "s4")),
    ("finish_quiz", "u2", ts("2024-01-05 09:00"), props(RN, "s5")),
    ("view_event", "u3b", ts("2024-01-05 10:00"), props(RN, "s6")),
    ("view_event", "ghost", ts("2024-01-06 10:00"), props(RN, "s7")),
    ("view_event", "+15550001", ts("2024-01-06 11:00"), "not json"),
    ("view_event", "u4", ts("2024-02-01 10:00"), props(RN, "s10")),
    ("open_app", "u2", ts("2024-01-07 09:00"), props(RN, "s8")),
]

SESSIONS = [
    ("s1", "+15550001", ts("2024-01-03 10:00"), ts("2024-01-03 10:06"), 360.0, 4, 2),
    ("s3", "u1b", ts("2024-01-25 09:00"), ts("2024-01-25 09:01"), 60.0, 1, 1),
    ("s4", "+15550001", ts("2024-01-01 09:00"), ts("2024-01-01 09:00"), 0.0, None, None),
    ("s6", "u3b", ts("2024-01-05 10:00"), ts("2024-01-05 10:00:10"), 10.0, 1, 1),
    ("s8", "u2", ts("2024-01-07 09:00"), ts("2024-01-07 09:00"), 0.0, 0, 0),
]

APP_EVENTS = [("u1", ts("2024-01-03 10:03")), ("u9", ts("2024-01-20 12:00"))]

INVITES = [("u1", ts("2024-01-03"), "accepted"), ("u1b", ts("2024-01-03"), "invited"),
           ("u2", ts("2024-01-02"), "pending")]

EXCLUDED = [("+15550003",)]


def golden(spark, **overrides):
    data = {"users": USERS, "product_events": PRODUCT_EVENTS, "sessions": SESSIONS,
            "app_events": APP_EVENTS, "invites": INVITES, "excluded": EXCLUDED}
    data.update(overrides)
    return {k: spark.createDataFrame(v, schemas.INPUTS[k]) for k, v in data.items()}
