"""Registered queries: one per inventory operator, each ``(spark, sf_dir) -> DataFrame``.

Every query derives the engine's inputs from the driver tables at
``sf_dir`` (see ``cadence.sources.adapters``), runs over whole tables and
returns a lazy DataFrame. ``cadence.oracle_sql`` holds the DuckDB twin of
each. Parameters are fixed per query set (``ORACLE_PARAMS``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence import schemas
from cadence.functions.conform import conform, utc_literal
from cadence.operators import activity, churn, identity, people, sessions
from cadence.params import Params
from cadence.plans import history, incremental, pipeline
from cadence.plans.pipeline import Inputs
from cadence.session import prepare, scratch_path
from cadence.sources import adapters, readers, sinks

# The events span 2024-01-01..2024-01-30: this end date and threshold give
# active, reactivated, churned and never-active users of both kinds.
ORACLE_PARAMS = Params.of("2024-01-31", threshold_days=2, run_ts="2024-01-31 00:00:00",
                          since=dt.datetime(2024, 1, 15))
TRIAL_ROWS = 100
FLOAT_DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    prepare(spark)
    return Inputs.of(adapters.load_inputs(spark, sf_dir))


P = ORACLE_PARAMS


# ------------------------------------------------------------- S1, S6

@register("events_since")
def events_since(spark, sf_dir):
    return readers.since_filter(inputs(spark, sf_dir).product_events, P.since)


@register("events_limited_ordered")
def events_limited_ordered(spark, sf_dir):
    ev = inputs(spark, sf_dir).product_events
    return readers.cap_rows(ev, TRIAL_ROWS, ["timestamp", "distinct_id", "event", "properties"])


# ------------------------------------------------------------- S2-S5

def _stored(name: str):
    """Input ``name`` stored as a table of its own and read by the engine's reader."""
    def query(spark, sf_dir):
        prepare(spark)
        path = scratch_path(spark, f"source-{name}")
        adapters.load_inputs(spark, sf_dir)[name].write.parquet(path)
        return readers.read_source(spark, path, name)
    return query


for _name in ("sessions", "users", "app_events", "invites"):
    register(f"source_{_name}")(_stored(_name))


# ------------------------------------------------------------- P1-P4

@register("json_events_extracted")
def json_events_extracted(spark, sf_dir):
    return sessions.parse_properties(inputs(spark, sf_dir).product_events)


@register("mobile_events_filtered")
def mobile_events_filtered(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return sessions.extract_events(i.product_events, i.excluded, P.mobile_lib)


# ------------------------------------------------------------- identity

@register("users_dedup_name_phone")
def users_dedup_name_phone(spark, sf_dir):
    return sessions.dedupe_users(inputs(spark, sf_dir).users)


@register("users_dedup_complete")
def users_dedup_complete(spark, sf_dir):
    return identity.user_lookup(inputs(spark, sf_dir).users)


@register("user_profile")
def user_profile(spark, sf_dir):
    return identity.user_profile(identity.user_lookup(inputs(spark, sf_dir).users))


@register("canonical_map")
def canonical_map(spark, sf_dir):
    u = inputs(spark, sf_dir).users
    return identity.canonical_map(u, identity.user_lookup(u))


@register("excluded_user_ids")
def excluded_user_ids(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return identity.excluded_ids(identity.user_lookup(i.users), i.excluded)


# ------------------------------------------------------------- sessions

def _behaviour(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return sessions.session_behaviour(sessions.extract_events(i.product_events, i.excluded, P.mobile_lib))


@register("session_flags")
def session_flags(spark, sf_dir):
    names = list(schemas.SESSION_FLAGS) + ["started_quiz", "completed_quiz"]
    names.remove("created_event")
    return _behaviour(spark, sf_dir).select("session_id", *names)


@register("session_scrolls")
def session_scrolls(spark, sf_dir):
    return _behaviour(spark, sf_dir).select("session_id", "scrolled", "scroll_event_count")


@register("session_first_geo")
def session_first_geo(spark, sf_dir):
    return _behaviour(spark, sf_dir).select("session_id", "distinct_id", "city", "country")


@register("session_metadata_join")
def session_metadata_join(spark, sf_dir):
    i = inputs(spark, sf_dir)
    b = sessions.session_behaviour(sessions.extract_events(i.product_events, i.excluded, P.mobile_lib))
    return sessions.attach_metadata(b, i.sessions, i.excluded).select(
        "session_id", "distinct_id", *sessions.META_COLS)


def _matched(i: Inputs):
    b = sessions.session_behaviour(sessions.extract_events(i.product_events, i.excluded, P.mobile_lib))
    m = sessions.attach_metadata(b, i.sessions, i.excluded)
    return sessions.match_users(m, i.users).where(F.col("user_id").isNotNull())


@register("session_user_match")
def session_user_match(spark, sf_dir):
    return _matched(inputs(spark, sf_dir)).select(
        "session_id", "distinct_id", "match_rank", *sessions.USER_COLS)


@register("session_created_event")
def session_created_event(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return sessions.created_during(_matched(i), i.app_events)


@register("sessions_aggregated")
def sessions_aggregated(spark, sf_dir):
    return pipeline.sessions_aggregated(inputs(spark, sf_dir), P)


@register("conform_missing_columns")
def conform_missing_columns(spark, sf_dir):
    """Per-session behaviour conformed to the sessions_aggregated schema
    (user and metadata columns absent -> NULL / False)."""
    return conform(_behaviour(spark, sf_dir), schemas.SESSIONS_AGGREGATED, P.run_ts)


# ------------------------------------------------------------- people

# Computed so that both engines produce the same bits: exact decimal sums,
# then one IEEE operation. Only the standard deviation (a square root of
# float sums) can differ in the last bits, so it alone is rounded for the
# comparison; rounding the others would be unsafe, since means of
# microsecond values often fall exactly on a rounding tie.
ROUNDED_FOR_COMPARISON = ["std_session_duration"]


def round_floats(df: DataFrame, digits: int = FLOAT_DIGITS) -> DataFrame:
    """Round the columns of ``ROUNDED_FOR_COMPARISON`` present in ``df``.
    (The library functions themselves keep full precision.)"""
    return df.select(*[F.round(c, digits).alias(c) if c in ROUNDED_FOR_COMPARISON else F.col(c)
                       for c in df.columns])


def _people(spark, sf_dir):
    return round_floats(pipeline.people_aggregated(pipeline.sessions_aggregated(inputs(spark, sf_dir), P), P))


@register("people_durations")
def people_durations(spark, sf_dir):
    return _people(spark, sf_dir).select(
        "user_id", "total_sessions", "avg_session_duration", "median_session_duration",
        "total_session_duration", "min_session_duration", "max_session_duration",
        "std_session_duration")


@register("people_flags")
def people_flags(spark, sf_dir):
    return _people(spark, sf_dir).select("user_id", *[f"{c}_sum" for c in schemas.PEOPLE_FLAG_SUMS])


@register("people_counts")
def people_counts(spark, sf_dir):
    cols = [c for t in people.COUNTS.values() for c in t]
    return _people(spark, sf_dir).select("user_id", *cols, "first_session_date", "last_session_date")


@register("people_profile")
def people_profile(spark, sf_dir):
    return _people(spark, sf_dir).select("user_id", *people.PROFILE)


@register("people_aggregated")
def people_aggregated(spark, sf_dir):
    return _people(spark, sf_dir)


# ------------------------------------------------------------- daily activity

def _daily(spark, sf_dir):
    return pipeline.daily_frames(inputs(spark, sf_dir), P)


@register("daily_product_counts")
def daily_product_counts(spark, sf_dir):
    return activity.product_daily_counts(inputs(spark, sf_dir).product_events).withColumnRenamed(
        "key", "distinct_id")


@register("daily_created_invites")
def daily_created_invites(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return activity.created_and_invites_daily(i.app_events, i.invites).withColumnRenamed("key", "user_id")


@register("activity_spine")
def activity_spine(spark, sf_dir):
    return _daily(spark, sf_dir)["spine"]


@register("user_date_grid")
def user_date_grid(spark, sf_dir):
    f = _daily(spark, sf_dir)
    return activity.daily_grid(f["ranges"], P.end_date).select("user_id", "date")


@register("user_daily_activity")
def user_daily_activity(spark, sf_dir):
    return pipeline.user_daily_activity(_daily(spark, sf_dir), P)


# ------------------------------------------------------------- churn

@register("activity_gaps")
def activity_gaps(spark, sf_dir):
    g = churn.activity_gaps(_daily(spark, sf_dir)["in_range"])
    return g.where(F.col("app") | F.col("biz")).select("user_id", "date", "app", "biz", "app_gap", "biz_gap")


def _churn(spark, sf_dir):
    return pipeline.user_churn_state(_daily(spark, sf_dir)["in_range"], P)


@register("app_churn")
def app_churn(spark, sf_dir):
    return _churn(spark, sf_dir).select(
        "user_id", *[c for c in schemas.USER_CHURN_STATE.fieldNames() if "app_" in c and "total" not in c])


@register("biz_churn")
def biz_churn(spark, sf_dir):
    return _churn(spark, sf_dir).select(
        "user_id", *[c for c in schemas.USER_CHURN_STATE.fieldNames() if "biz" in c])


@register("activity_totals")
def activity_totals(spark, sf_dir):
    return _churn(spark, sf_dir).select("user_id", "total_events_created", "total_events_attended",
                                        "total_app_interactions")


@register("user_churn_state")
def user_churn_state(spark, sf_dir):
    return _churn(spark, sf_dir)


@register("user_churn_state_from_grid")
def user_churn_state_from_grid(spark, sf_dir):
    return pipeline.user_churn_state(_daily(spark, sf_dir)["daily"], P)


# ------------------------------------------------------------- sinks

@register("load_overwrite_append")
def load_overwrite_append(spark, sf_dir):
    """S7 + S9 + S10: overwrite, then append the same rows; read back."""
    target = scratch_path(spark, "load_overwrite_append")
    df = _churn(spark, sf_dir)
    first = sinks.write_table(df, target, "overwrite", schema=schemas.USER_CHURN_STATE, skip_empty=False)
    second = sinks.write_table(df, target, "append", schema=schemas.USER_CHURN_STATE, skip_empty=False)
    assert first.rows_written == second.rows_written
    return sinks.read_back(spark, target)


@register("load_empty_skipped")
def load_empty_skipped(spark, sf_dir):
    """An empty frame leaves the table as it was."""
    target = scratch_path(spark, "load_empty_skipped")
    df = _churn(spark, sf_dir)
    sinks.write_table(df, target, "overwrite", schema=schemas.USER_CHURN_STATE)
    res = sinks.write_table(df.where(F.lit(False)), target, "overwrite")
    assert res.skipped
    return sinks.read_back(spark, target)


@register("load_new_database")
def load_new_database(spark, sf_dir):
    """A table published in a database that did not exist, twice."""
    place = scratch_path(spark, "load_new_database")
    name = "cadence_" + place.rpartition("-")[2]
    sinks.ensure_database(spark, name, place)
    df = _churn(spark, sf_dir)
    for _ in range(2):
        sinks.write_table(df, f"{name}.user_churn_state", "overwrite", schema=schemas.USER_CHURN_STATE, skip_empty=False)
    return sinks.read_back(spark, f"{name}.user_churn_state")


# ------------------------------------------------------------- I1

def _staged(spark, sf_dir) -> Inputs:
    """The inputs for queries that read them many times."""
    prepare(spark)
    return Inputs.of(adapters.load_staged(spark, sf_dir))


def _refreshed(spark, i: Inputs, sides: bool = False) -> incremental.State:
    """The state of the events before ``since``, refreshed by the later ones. With
    ``sides`` the other inputs were as of ``since``, too: younger users, metadata, app events
    and invites not yet there and nobody excluded."""
    at = utc_literal(P.since)
    known = lambda df, c: df.where(F.col(c).isNull() | (F.col(c) < at))
    old = Inputs(i.product_events, known(i.sessions, "start_timestamp"), known(i.users, "createdAt"), known(i.app_events, "createdAt"),
                 known(i.invites, "createdAt"), i.excluded.where(F.lit(False))) if sides else i
    first = incremental.refresh(incremental.empty_state(spark), old, i.product_events.where(F.col("timestamp") < at), P)
    return incremental.refresh(first, i, readers.since_filter(i.product_events, P.since), P)


@register("incremental_sessions")
def incremental_sessions(spark, sf_dir):
    return _refreshed(spark, _staged(spark, sf_dir)).sessions_aggregated


@register("incremental_people")
def incremental_people(spark, sf_dir):
    return round_floats(_refreshed(spark, _staged(spark, sf_dir)).people_aggregated)


@register("incremental_spine")
def incremental_spine(spark, sf_dir):
    i = _staged(spark, sf_dir)
    return incremental.spine_from_state(_refreshed(spark, i).counts, i)


@register("incremental_all_inputs_sessions")
def incremental_all_inputs_sessions(spark, sf_dir):
    return _refreshed(spark, _staged(spark, sf_dir), sides=True).sessions_aggregated


@register("incremental_all_inputs_people")
def incremental_all_inputs_people(spark, sf_dir):
    return round_floats(_refreshed(spark, _staged(spark, sf_dir), sides=True).people_aggregated)


# ------------------------------------------------------------- S1 over stored tables

def _history(spark, sf_dir) -> tuple[history.History, Inputs]:
    """The history of a full load in which the days from ``since`` on had other events, after a dated run."""
    i = inputs(spark, sf_dir)
    folder = scratch_path(spark, "history")
    wrong = i.product_events.withColumn("distinct_id", F.when(F.col("timestamp") < utc_literal(P.since), F.col("distinct_id")).otherwise("event"))
    history.replace_days(spark, folder, wrong, dataclasses.replace(P, since=None))
    return history.replace_days(spark, folder, i.product_events, P), i


@register("since_over_stored_sessions")
def since_over_stored_sessions(spark, sf_dir):
    held, i = _history(spark, sf_dir)
    return conform(history.sessions_aggregated(held, i, stage=lambda df: df.checkpoint()), schemas.SESSIONS_AGGREGATED, P.run_ts)


@register("since_over_stored_spine")
def since_over_stored_spine(spark, sf_dir):
    return history.spine(*_history(spark, sf_dir))
