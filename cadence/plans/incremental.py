"""Incremental refresh (I1): from the last run's state and what is new since.

The state holds what a refresh needs instead of the event history:

* ``events``: per (session_id, distinct_id) the mergeable behaviour of
  ``sessions.event_state``; a batch of events is reduced to the same form and
  merged in, so no old event is read again;
* ``counts``: product events per (distinct_id, day), merged by sums; identities
  are resolved when the spine is derived;
* ``users`` (deduplicated), ``excluded`` (ids), ``metadata`` and ``app`` (a row
  count and hash sum per session id / user id): the side inputs as they were.

Any input may have changed. The side inputs are compared with the state and
their differences are carried through the joins to session ids:

* events: the sessions of the batch;
* session metadata (J1): the session ids whose rows differ;
* users (W1, J2, J3): deduplicated users that differ, by phone and user id to
  the sessions that any event ties to one of those ids;
* exclusion list (P3, P5): ids that came or went, to the sessions of their events;
* app events (J4): users whose rows differ, to the sessions they were matched to.

Only these sessions are derived anew from the merged state, and only the people
who had or have one of them from the merged sessions. Invites, and all inputs of the
daily tables, are read whole when the spine is derived from ``counts``. Each
result equals a full refresh over the inputs as they are now (the tests change
each input in turn).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence import schemas
from cadence.functions.conform import conform
from cadence.functions.joins import broadcast_if_small
from cadence.operators import activity, sessions
from cadence.params import Params
from cadence.plans import pipeline
from cadence.plans.pipeline import Inputs
from cadence.session import scratch_path

_FIRST = "struct<no_time: boolean, time: timestamp, value: string>"
STATE_SCHEMAS = {
    "events": "session_id string, distinct_id string, seen struct<no_time: boolean, time: timestamp>, "
              f"city {_FIRST}, country {_FIRST}, " + ", ".join(f"{c} boolean" for c in sessions.BEHAVIOUR_FLAGS) + ", touches long",
    "counts": "key string, date date, event_count long",
    "users": ", ".join(f"{c} {schemas.USERS[c].dataType.simpleString()}" for c in sessions.USER_COLS),
    "excluded": "id string",
    "metadata": "key string, n long, hashes decimal(38,0)",
    "app": "key string, n long, hashes decimal(38,0)",
    "sessions_aggregated": schemas.SESSIONS_AGGREGATED,
    "people_aggregated": schemas.PEOPLE_AGGREGATED,
}


@dataclass
class State:
    """Everything one run leaves to the next."""
    events: DataFrame
    counts: DataFrame
    users: DataFrame
    excluded: DataFrame
    metadata: DataFrame
    app: DataFrame
    sessions_aggregated: DataFrame
    people_aggregated: DataFrame

    @staticmethod
    def names() -> list[str]:
        return [f.name for f in fields(State)]


# Stores a frame under a name and returns it without its lineage.
Keep = Callable[[str, DataFrame], DataFrame]


def as_table(name: str, df: DataFrame) -> DataFrame:
    """Stored in the shared folder. (A checkpoint keeps the size that was estimated for its
    plan, a product over the joins of every run before: too long to plan with after some runs.)"""
    path = scratch_path(df.sparkSession, f"state-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_state(spark: SparkSession) -> State:
    # The condition makes them known as empty to the optimizer, which leaves out joins with them.
    return State(**{name: spark.createDataFrame([], STATE_SCHEMAS[name]).where(F.lit(False)) for name in State.names()})


def fingerprint(df: DataFrame, key: str) -> DataFrame:
    """``key, n, hashes``: rows per key and the sum of their hashes (rows may repeat)."""
    # Summed in halves, which are longs; a decimal buffer costs more than the rest of the aggregate.
    h = F.xxhash64(*sorted(df.columns))
    halves = df.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(h, 32)).alias("_high"), F.sum(h.bitwiseAND(0xFFFFFFFF)).alias("_low"))
    total = F.col("_high").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_low").cast("decimal(19,0)")
    return halves.select("key", "n", total.cast("decimal(38,0)").alias("hashes"))


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """The non-null keys of two fingerprints whose rows came, went or differ."""
    both = old.unionByName(new).where(F.col("key").isNotNull())
    same = (F.count(F.lit(1)) == 2) & (F.min("n") == F.max("n")) & (F.min("hashes") == F.max("hashes"))
    return both.groupBy("key").agg(same.alias("same")).where(~F.col("same")).select("key")


def differing_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of two frames with equal columns that one has more often than the other."""
    side = lambda df, n: df.withColumn("_side", F.lit(n))
    return (side(old, -1).unionByName(side(new, 1)).groupBy(*old.columns).agg(F.sum("_side").alias("_side"))
            .where(F.col("_side") != 0).drop("_side"))


def touched_sessions(old: State, delta: DataFrame, users: DataFrame, excluded: DataFrame,
                     metadata: DataFrame, app: DataFrame, keep: Keep) -> DataFrame:
    """Distinct session ids that new events or a changed side input can alter. ``delta`` is the
    batch's state, all of whose sessions are touched, so that changed ids are looked up in the old
    state only; the others are the side inputs in the state's form."""
    moved = differing_rows(old.users, users)
    ids = (moved.select(F.col("phoneNumber").alias("id")).unionByName(moved.select(F.col("user_id").alias("id")))
           .unionByName(differing_rows(old.excluded, excluded)).where(F.col("id").isNotNull()).distinct())
    ids = broadcast_if_small(keep("changed_ids", ids))
    by_id = old.events.join(ids, F.col("distinct_id") == F.col("id"), "left_semi").select("session_id")
    by_meta = changed_keys(old.metadata, metadata).select(F.col("key").alias("session_id"))
    of_app = broadcast_if_small(keep("changed_app", changed_keys(old.app, app)))
    by_app = old.sessions_aggregated.join(of_app, F.col("user_id") == F.col("key"), "left_semi").select("session_id")
    return (delta.select("session_id").unionByName(by_id).unionByName(by_meta).unionByName(by_app).distinct())


def refresh(old: State, inp: Inputs, delta_events: DataFrame, p: Params, keep: Keep = as_table) -> State | None:
    """The state after ``delta_events`` and with the side inputs of ``inp``; ``inp.product_events``
    is not read. None if nothing that the outputs depend on has changed."""
    if all(getattr(old, name).isEmpty() for name in State.names()):
        return _first_load(inp, delta_events, p, keep)
    delta = keep("delta", sessions.event_state(sessions.mobile_events(delta_events, p.mobile_lib)))
    counts = activity.merge_product_counts(old.counts, activity.product_daily_counts(delta_events))
    events = keep("events", sessions.merge_event_states(old.events, delta))
    users = keep("users", sessions.dedupe_users(inp.users))
    excluded = keep("excluded", inp.excluded.select("id").where(F.col("id").isNotNull()).distinct())
    metadata = keep("metadata", fingerprint(inp.sessions, "session_id"))
    app = keep("app", fingerprint(inp.app_events, "user_id"))
    touched = keep("touched", touched_sessions(old, delta, users, excluded, metadata, app, keep))
    if touched.isEmpty() and delta_events.isEmpty():
        return None

    scoped = events.join(touched, "session_id", "left_semi")
    about = inp.sessions.join(touched, "session_id", "left_semi")
    before = old.sessions_aggregated.join(touched, "session_id", "left_semi").select("user_id")

    fresh = sessions.from_behaviour(sessions.behaviour_of_state(scoped, excluded), about, users, inp.app_events, excluded,
                                    stage=lambda df: keep("matched", df), few_users=True, deduped=True)
    fresh = keep("fresh", conform(fresh, schemas.SESSIONS_AGGREGATED, p.run_ts))
    merged = keep("sessions_aggregated", old.sessions_aggregated.join(touched, "session_id", "left_anti").unionByName(fresh))
    changed = keep("people_touched", before.unionByName(fresh.select("user_id")).distinct())
    people = pipeline.people_aggregated(merged.join(changed, "user_id", "left_semi"), p)
    return State(events, keep("counts", counts), users, excluded, metadata, app, merged,
                 keep("people_aggregated", old.people_aggregated.join(changed, "user_id", "left_anti").unionByName(people)))


def _first_load(inp: Inputs, delta_events: DataFrame, p: Params, keep: Keep) -> State | None:
    """``refresh`` of an empty state: every session and person is new, so nothing is compared with
    the state, looked up in it or merged into it."""
    events = keep("events", sessions.event_state(sessions.mobile_events(delta_events, p.mobile_lib)))
    users = keep("users", sessions.dedupe_users(inp.users))
    excluded = keep("excluded", inp.excluded.select("id").where(F.col("id").isNotNull()).distinct())
    metadata = keep("metadata", fingerprint(inp.sessions, "session_id"))
    app = keep("app", fingerprint(inp.app_events, "user_id"))
    if metadata.where(F.col("key").isNotNull()).isEmpty() and delta_events.isEmpty():
        return None
    rows = sessions.from_behaviour(sessions.behaviour_of_state(events, excluded), inp.sessions, users, inp.app_events, excluded,
                                   stage=lambda df: keep("matched", df), deduped=True)
    found = keep("sessions_aggregated", conform(rows, schemas.SESSIONS_AGGREGATED, p.run_ts))
    return State(events, keep("counts", activity.product_daily_counts(delta_events)), users, excluded, metadata, app, found,
                 keep("people_aggregated", pipeline.people_aggregated(found, p)))


def spine_from_state(product_counts: DataFrame, inp: Inputs) -> DataFrame:
    return activity.spine_from_counts(product_counts, inp.app_events, inp.invites, inp.users, inp.excluded)
