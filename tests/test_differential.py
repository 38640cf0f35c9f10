"""Randomised differential test: Spark pipeline vs. the SQL oracle on small
generated inputs that hit identity edge cases the derived test data lacks
(a user id with two phones, a phone string equal to a user id, excluded
phones shared by several users, null names/phones, malformed JSON).

Uniqueness is imposed only where the reference has no defined order
(duplicate (user_id, phone) rows, equal timestamps, duplicate session
metadata), so every result is fully determined.
"""

import datetime as dt
import json
import os

import duckdb
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle_compare import compare
from cadence import schemas
from cadence.oracle_sql import oracle_over_inputs
from cadence.plans import pipeline
from cadence.plans.catalog import ORACLE_PARAMS as P
from cadence.plans.catalog import round_floats
from cadence.plans.pipeline import Inputs

RN = P.mobile_lib
T0 = dt.datetime(2023, 12, 20)
USER_IDS = ["u1", "u2", "u3", "u4"]
PHONES = ["+1", "+2", "+3", "u1", None]  # "u1" is also a user id
IDS = ["+1", "+2", "+3", "u1", "u2", "u3", "u4", "ghost", None]
EVENTS = ["view_event", "join_event", "invite_friends", "Contacts_Enabled", "start_quiz",
          "finish_quiz", "click_invite_to_event", "other"]
SESSIONS = ["s1", "s2", "s3", "s4"]

_PA = {"string": pa.string(), "timestamp": pa.timestamp("us"), "boolean": pa.bool_(),
       "double": pa.float64(), "bigint": pa.int64()}

maybe = lambda s: st.one_of(st.none(), s)
minutes = st.integers(0, 60 * 24 * 45)
ts = minutes.map(lambda m: T0 + dt.timedelta(minutes=m))

user = st.tuples(st.sampled_from(USER_IDS), maybe(st.sampled_from(["Ann", "Bo"])), st.sampled_from(PHONES),
                 maybe(st.sampled_from(["a", "b"])), maybe(st.sampled_from(["a@x", "b@x"])),
                 maybe(st.booleans()), maybe(st.booleans()), maybe(ts))
users = st.lists(user, min_size=1, max_size=7, unique_by=lambda u: (u[0], u[2]))


@st.composite
def product_event(draw):
    props = {"$lib": draw(st.sampled_from([RN, RN, "web"])),
             "$session_id": draw(maybe(st.sampled_from(SESSIONS))),
             "$screen_name": draw(maybe(st.sampled_from(["Discover", "Home"]))),
             "$geoip_city_name": draw(maybe(st.sampled_from(["X", "Y"]))),
             "$geoip_country_name": draw(maybe(st.sampled_from(["C"]))),
             "$touch_x": draw(maybe(st.integers(0, 9))), "$touch_y": draw(maybe(st.integers(0, 9)))}
    text = draw(st.sampled_from([json.dumps(props)] * 6 + ["not json"]))
    return (draw(st.sampled_from(EVENTS)), draw(st.sampled_from(IDS)), draw(minutes), text)


product_events = st.lists(product_event(), max_size=14, unique_by=lambda e: e[2])


@st.composite
def session_meta(draw, sid):
    start = draw(minutes)
    length = draw(st.integers(0, 300))
    return (sid, draw(st.sampled_from(IDS)), T0 + dt.timedelta(minutes=start),
            T0 + dt.timedelta(minutes=start + length),
            draw(st.sampled_from([None, 0.0, 10.5, 60.000001, float(length * 60)])),
            draw(maybe(st.integers(0, 3))), draw(maybe(st.integers(0, 3))))


@st.composite
def inputs(draw):
    metas = [draw(session_meta(s)) for s in SESSIONS if draw(st.booleans())]
    return {
        "users": draw(users),
        "product_events": [(e, d, T0 + dt.timedelta(minutes=m), p) for e, d, m, p in draw(product_events)],
        "sessions": metas,
        "app_events": draw(st.lists(st.tuples(st.sampled_from(USER_IDS + ["x9"]), maybe(ts)), max_size=8)),
        "invites": draw(st.lists(st.tuples(st.sampled_from(USER_IDS), maybe(ts),
                                           maybe(st.sampled_from(["accepted", "invited", "rejected", "pending"]))),
                                 max_size=8)),
        "excluded": [(p,) for p in draw(st.lists(st.sampled_from(["+1", "+2", "u1"]), max_size=2, unique=True))],
    }


def _arrow(rows, schema):
    fields = [pa.field(f.name, _PA[f.dataType.simpleString()]) for f in schema.fields]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table({f.name: pa.array(list(c), type=f.type) for f, c in zip(fields, cols)})


OUTPUTS = ["activity_spine", "sessions_aggregated", "people_aggregated", "user_daily_activity",
           "user_churn_state"]


EXAMPLES = int(os.environ.get("CADENCE_DIFF_EXAMPLES", "8"))


@settings(max_examples=EXAMPLES, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=inputs())
def test_pipeline_equals_oracle_on_random_inputs(spark, data):
    frames = {k: spark.createDataFrame(v, schemas.INPUTS[k]) for k, v in data.items()}
    inp = Inputs.of(frames)
    daily = pipeline.daily_frames(inp, P)
    sess = pipeline.sessions_aggregated(inp, P)
    ours = {
        "activity_spine": daily["spine"],
        "sessions_aggregated": sess,
        "people_aggregated": round_floats(pipeline.people_aggregated(sess, P)),
        "user_daily_activity": pipeline.user_daily_activity(daily, P),
        "user_churn_state": pipeline.user_churn_state(daily["in_range"], P),
    }
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name, rows in data.items():
        con.register(name, _arrow(rows, schemas.INPUTS[name]))
    for name in OUTPUTS:
        ok, msg = compare(ours[name], con, oracle_over_inputs(name))
        assert ok, f"{name}: {msg}\ninputs: {data}"
        if os.environ.get("CADENCE_DIFF_VERBOSE"):
            print(name, msg)
