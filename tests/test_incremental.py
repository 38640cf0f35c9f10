"""Incremental refresh: streamed batches of new event files equal a full refresh."""

import dataclasses
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from oracle_compare import normalise
from cadence import schemas
from cadence.plans import incremental, pipeline
from cadence.plans.catalog import ORACLE_PARAMS
from cadence.plans.pipeline import Inputs
from cadence.sources import adapters, readers, sinks
from cadence.streaming import incremental as stream_inc

SF = "/root/testdata/sf0.001"


def _rows(df):
    return normalise(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def staged(spark):
    """Derived inputs stored as parquet; product events split into three
    files by time, the third held back."""
    base = tempfile.mkdtemp(prefix="cadence-inc-")
    derived = adapters._derive(spark, SF)
    sources = {}
    for name, df in derived.items():
        if name == "product_events":
            continue
        sources[name] = f"{base}/{name}"
        df.write.parquet(sources[name])
    ev = derived["product_events"]
    sources["product_events"] = f"{base}/product_events"
    cuts = ["2024-01-10", "2024-01-20"]
    parts = [ev.where(F.col("timestamp") < cuts[0]),
             ev.where((F.col("timestamp") >= cuts[0]) & (F.col("timestamp") < cuts[1])),
             ev.where(F.col("timestamp") >= cuts[1])]
    for i, part in enumerate(parts[:2]):
        part.coalesce(1).write.mode("append").parquet(sources["product_events"])
    return base, sources, parts


def _full(spark, sources):
    inp = Inputs.of(readers.read_inputs(spark, sources))
    s = pipeline.sessions_aggregated(inp, ORACLE_PARAMS)
    return s, pipeline.people_aggregated(s, ORACLE_PARAMS), pipeline.daily_frames(inp, ORACLE_PARAMS)["spine"]


def _check(spark, sources, state_dir):
    s, p, sp = _full(spark, sources)
    state = stream_inc.latest(spark, state_dir)
    for name, full in (("sessions_aggregated", s), ("people_aggregated", p)):
        assert _rows(getattr(state, name).select(*full.columns)) == _rows(full), name
    inp = Inputs.of(readers.read_inputs(spark, sources))
    assert _rows(incremental.spine_from_state(state.counts, inp)) == _rows(sp)
    return state


def test_stream_equals_full_refresh(spark, staged):
    base, sources, parts = staged
    state = f"{base}/state"
    q = stream_inc.start(spark, sources, ORACLE_PARAMS, state_dir=state)
    q.awaitTermination(300)
    epoch = stream_inc.last_epoch(q)
    assert epoch >= 0
    assert not stream_inc.catch_up(spark, sources, ORACLE_PARAMS, state)   # nothing has changed

    # A new file arrives: the restarted stream processes only that file.
    parts[2].coalesce(1).write.mode("append").parquet(sources["product_events"])
    q2 = stream_inc.start(spark, sources, ORACLE_PARAMS, state_dir=state)
    q2.awaitTermination(300)
    epoch2 = stream_inc.last_epoch(q2)
    assert epoch2 == epoch + 1
    assert q2.lastProgress["numInputRows"] == parts[2].count()
    held = stream_inc.latest(spark, state)
    inp = Inputs.of(readers.read_inputs(spark, sources))
    daily = stream_inc.daily_from_state(held, inp, ORACLE_PARAMS)
    frames = pipeline.daily_frames(inp, ORACLE_PARAMS)
    assert _rows(daily["user_churn_state"]) == _rows(pipeline.user_churn_state(frames["in_range"], ORACLE_PARAMS))

    # A user's phone and the metadata of a session change, no event file is new.
    users = spark.read.parquet(sources["users"])
    sources = {**sources, "users": f"{base}/users2"}
    users.withColumn("phoneNumber", F.when(F.col("user_id") == users.agg(F.min("user_id")).first()[0], F.lit("+15559999")).otherwise(F.col("phoneNumber"))) \
        .write.parquet(sources["users"])
    for _ in range(stream_inc.SLOTS - 1):   # the last version takes the first one's slot
        assert stream_inc.catch_up(spark, sources, ORACLE_PARAMS, state)
        last, sources = sources, {**sources, "users": f"{base}/users" if sources["users"].endswith("2") else f"{base}/users2"}
    _check(spark, last, state)
    held = stream_inc.commits(spark, state)
    assert len(held) == stream_inc.SLOTS and held[-1][0] == stream_inc.SLOTS and {e for _, e in held} == {epoch2}


def test_cli_incremental_mode(spark, staged, tmp_path):
    """The job's --incremental mode: first run processes every file and the
    tables equal a full refresh; a rerun with nothing new still moves the grid on."""
    from cadence.plans import job
    import os
    base, sources, parts = staged
    src_dir = os.path.dirname(sources["users"])
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    args = ["--sources", src_dir, "--target", out, "--end-date", "2024-01-31", "--threshold", "2",
            "--incremental", state]
    assert job.main(args) == 0
    inp = Inputs.of(readers.read_inputs(spark, sources))
    full = pipeline.user_churn_state(pipeline.daily_frames(inp, ORACLE_PARAMS)["in_range"], ORACLE_PARAMS)
    got = sinks.read_back(spark, f"{out}/user_churn_state")
    assert _rows(got.drop("etl_loaded_at")) == _rows(full.drop("etl_loaded_at"))
    full_s = pipeline.sessions_aggregated(inp, ORACLE_PARAMS).drop("etl_loaded_at")
    got_s = sinks.read_back(spark, f"{out}/sessions_aggregated").drop("etl_loaded_at")
    assert _rows(got_s) == _rows(full_s)
    days = sinks.read_back(spark, f"{out}/user_daily_activity").count()
    later = dataclasses.replace(ORACLE_PARAMS, end_date=ORACLE_PARAMS.end_date + dt.timedelta(days=3))
    res = job.run_incremental(spark, sources, out, later, state)
    assert {r.status for r in res} == {"ok"}
    assert sinks.read_back(spark, f"{out}/user_daily_activity").count() > days
    frames = pipeline.daily_frames(inp, later)
    got = sinks.read_back(spark, f"{out}/user_churn_state").drop("etl_loaded_at")
    assert _rows(got) == _rows(pipeline.user_churn_state(frames["in_range"], later).drop("etl_loaded_at"))


def _events(*rows):
    return [(n, i, t and dt.datetime(2024, 1, t), '{"$session_id": "%s", "$lib": "%s"%s}' % (sid, ORACLE_PARAMS.mobile_lib, more))
            for n, i, t, sid, more in rows]


_STORED = {}


def _small(spark, **changed):
    """Six inputs by hand; a change replaces one of them."""
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    rows = {
        "product_events": _events(("view_event", "+1", 3, "s", ', "$geoip_city_name": "A"'), ("join_event", "+1", None, "s", ""), ("x", "u2", 2, "t", ', "$touch_x": 1'),
                                  ("x", "+9", 1, "v", ""), ("start_quiz", "+1", 4, "v", ""), ("x", "+3", 4, "w", "")),
        "sessions": [("s", "+1", day(3), day(3, 2), 5.0, 1, 2), ("t", "u2", day(2), day(2, 1), 7.0, 1, 1), ("v", "+9", day(1), day(1, 1), 1.0, 2, 2),
                     ("v", "+1", day(4), day(4, 1), 2.0, 2, 2), ("w", "+3", day(4), day(4, 1), 3.0, 2, 2)],
        "users": [("u1", "Ann", "+1", "ann", None, True, None, day(1)), ("u2", "Bob", "+2", "bob", None, None, False, day(1)),
                  ("u3", "Bob", "+2", "cob", None, None, False, day(1)), ("u4", "Dee", "+9", None, None, None, None, None)],
        "app_events": [("u1", day(3, 1)), ("u2", day(9))],
        "invites": [("u1", day(3), "accepted")],
        "excluded": [("+8",)],
    }
    assert set(changed) <= set(rows)
    rows.update(changed)
    frames = {}
    for k, v in rows.items():   # stored: read by many small jobs
        if (k, repr(v)) not in _STORED:
            _STORED[k, repr(v)] = incremental.as_table(k, spark.createDataFrame(v, schemas.INPUTS[k]).coalesce(1))
        frames[k] = _STORED[k, repr(v)]
    return Inputs.of(frames), rows


D = lambda d, h=0: dt.datetime(2024, 1, d, h)
# Changes of one round concern different sessions; each round also takes the one before back.
CHANGES = {
    "metadata of a session, app events of another one's user": lambda r: {
        "sessions": r["sessions"][1:] + [("s", "+1", D(9), D(9, 1), 8.0, 3, 3), ("s", "+1", D(3), D(3), 8.0, 3, 3)],
        "app_events": [r["app_events"][0], ("u2", D(2, 1)), ("u2", D(2, 1)), (None, D(2))]},
    "profile, user gone, other user of a name and phone first, unmatched phone taken": lambda r: {
        "users": [("u1", "Ann", "+1", "ann", "a@b.c", True, None, D(1)), r["users"][1], ("u3", "Bob", "+2", "aob", None, None, False, None),
                  ("u5", "Eve", "+3", None, None, None, None, None)]},
    "excluded ids, second user of a phone, invites": lambda r: {
        "excluded": [("+9",), ("u2",)], "users": [*r["users"], ("u5", "Eve", "+1", None, None, None, None, None)],
        "invites": [("u2", D(3), "rejected"), ("u1", D(5), "pending")]},
    "nobody excluded": lambda r: {"excluded": []},
}


def test_changes_of_every_input_equal_a_full_refresh(spark):
    """One input after the other changes, without new events; then all are as at first."""
    inp, rows = _small(spark)
    full = lambda i: pipeline.sessions_aggregated(i, ORACLE_PARAMS)
    state = incremental.refresh(incremental.empty_state(spark), inp, inp.product_events, ORACLE_PARAMS)
    none = inp.product_events.where("false")
    for name, change in CHANGES.items():
        now, _ = _small(spark, **change(rows))
        state = incremental.refresh(state, now, none, ORACLE_PARAMS)
        want = incremental.as_table("want", full(now))
        assert _rows(state.sessions_aggregated.select(*want.columns)) == _rows(want), name
        people = pipeline.people_aggregated(want, ORACLE_PARAMS)
        assert _rows(state.people_aggregated.select(*people.columns)) == _rows(people), name
    spine = pipeline.daily_frames(now, ORACLE_PARAMS)["spine"]
    assert _rows(incremental.spine_from_state(state.counts, now).select(*spine.columns)) == _rows(spine)
    assert incremental.refresh(state, now, none, ORACLE_PARAMS) is None   # nothing has changed


def test_old_events_of_a_touched_session_count(spark):
    """A session touched by a new event has the behaviour of all its events, however
    old, and of those without a timestamp, and no old event is read for it."""
    inp, rows = _small(spark)
    later = spark.createDataFrame(_events(("view_event", "u7", 5, "s", ""), ("x", "+1", 2, "t", "")), schemas.PRODUCT_EVENTS)
    first = incremental.refresh(incremental.empty_state(spark), inp, inp.product_events, ORACLE_PARAMS)
    unread = dataclasses.replace(inp, product_events=None)
    state = incremental.refresh(first, unread, later, ORACLE_PARAMS)
    want = pipeline.sessions_aggregated(dataclasses.replace(inp, product_events=inp.product_events.unionByName(later)), ORACLE_PARAMS)
    assert _rows(state.sessions_aggregated.select(*want.columns)) == _rows(want)
    assert state.sessions_aggregated.where("session_id = 's' AND joined_event").count() == 1


def test_refresh_reads_no_old_event(spark, staged, tmp_path):
    """The files that a second batch reads are the state's, the side inputs' and its own."""
    base, sources, parts = staged
    inp = Inputs.of(readers.read_inputs(spark, sources))
    state = incremental.refresh(incremental.empty_state(spark), inp, parts[0], ORACLE_PARAMS)
    read = []

    def keep(name, df):
        read.extend(df.inputFiles())
        return incremental.as_table(name, df)

    parts[2].write.parquet(str(tmp_path / "delta"))
    incremental.refresh(state, inp, spark.read.parquet(str(tmp_path / "delta")), ORACLE_PARAMS, keep)
    files = lambda name: {f for f in read if f"/{name}/" in f}
    assert files("users") and files("delta") and not files("product_events")


def test_first_load_compares_nothing(spark):
    """An empty state is not merged into or searched for what changed, and the result is a full refresh's."""
    inp, _ = _small(spark)
    kept = []

    def keep(name, df):
        kept.append(name)
        return incremental.as_table(name, df)

    state = incremental.refresh(incremental.empty_state(spark), inp, inp.product_events, ORACLE_PARAMS, keep)
    assert sorted(kept) == sorted([*incremental.State.names(), "matched"])
    want = pipeline.sessions_aggregated(inp, ORACLE_PARAMS)
    assert _rows(state.sessions_aggregated.select(*want.columns)) == _rows(want)
    none = Inputs.of({n: spark.createDataFrame([], schemas.INPUTS[n]) for n in ("product_events", "sessions", "users", "app_events", "invites", "excluded")})
    assert incremental.refresh(incremental.empty_state(spark), none, none.product_events, ORACLE_PARAMS) is None


def test_staged_inputs_read_the_events_once(spark):
    """Inputs for many reads come from the stored events and equal the derived ones."""
    staged, derived = adapters.load_staged(spark, SF), adapters._derive(spark, SF)
    for name in ("product_events", "sessions", "app_events", "invites"):
        files = staged[name].inputFiles()
        assert files and all("/staged-" in f for f in files), name
        assert staged[name].schema.fieldNames() == derived[name].schema.fieldNames()
        assert _rows(staged[name]) == _rows(derived[name]), name
