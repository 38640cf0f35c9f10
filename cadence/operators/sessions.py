"""Sessions: product events -> one row per (session, matched user).

Steps and their plan shape:

1. ``extract_events`` (P1-P4, F1): ``from_json`` into a fixed struct of seven
   string fields (malformed or null JSON gives null fields, so the row falls
   out at the lib / session filter instead of failing the run, and are
   counted when an ``Observation`` is passed, D16), keep the
   mobile lib and rows with a session id, drop excluded ``distinct_id`` with
   a left-anti join (null ids kept, D2). The exclusion list is broadcast only
   after its size is checked.
2. ``session_behaviour`` (A1-A3, F2-F5): one ``groupBy(session_id)`` of
   conditional aggregates; "first" is by event time then value (D15).
3. ``attach_metadata`` (P5, J1): left join on (session_id, distinct_id).
4. ``match_users`` (W1, J2, J3, O3): dedupe users on (name, phone), then one
   pass of two left joins: by phone, and by user id only where the phone
   join found nothing. Fan-out from a shared phone is kept (D5).
5. P6 / P7: drop unmatched and idle sessions.
6. ``with_created`` (J4): does the user have an app event inside
   [start, end]? Computed from the next event per (user, hour), never by
   pairing sessions with events (see ``with_created``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions import flags
from cadence.functions.joins import broadcast_if_small, first_non_null, keep_first
from cadence.schemas import PROPERTIES

USER_COLS = ["user_id", "fullName", "phoneNumber", "username", "email",
             "contactAccessGranted", "businessUser", "createdAt"]
META_COLS = ["start_timestamp", "end_timestamp", "autocapture_count", "screen_count",
             "session_duration"]
_PROPERTY_COLUMNS = {"$session_id": "session_id", "$lib": "lib", "$screen_name": "screen_name",
                     "$geoip_city_name": "city", "$geoip_country_name": "country",
                     "$touch_x": "touch_x", "$touch_y": "touch_y"}


_CORRUPT = "_corrupt_record"


def parse_properties(product_events: DataFrame, flag_malformed: bool = False) -> DataFrame:
    """Typed columns from the JSON ``properties`` string.

    The JSON is parsed once: ``inline`` keeps the optimizer from pushing the
    parse into each filter and projection above it.
    With ``flag_malformed`` a boolean ``properties_malformed`` is added: the
    text is not a JSON object (D16 - such rows are dropped, and counted).
    """
    schema, opts = PROPERTIES, {}
    if flag_malformed:
        schema = T.StructType(PROPERTIES.fields + [T.StructField(_CORRUPT, T.StringType())])
        opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = product_events.select(F.col("event").alias("event_name"), "distinct_id", "timestamp",
                                   F.inline(F.array(F.from_json("properties", schema, opts))))
    extra = [F.col(_CORRUPT).isNotNull().alias("properties_malformed")] if flag_malformed else []
    return parsed.select("event_name", "distinct_id", "timestamp",
                         *[F.col(f"`{k}`").alias(v) for k, v in _PROPERTY_COLUMNS.items()], *extra)


def exclude_ids(df: DataFrame, excluded: DataFrame, col: str = "distinct_id") -> DataFrame:
    """Drop rows whose ``col`` is excluded; null ``col`` is kept."""
    ex = broadcast_if_small(excluded.select(F.col("id").alias("_excluded_id")).distinct())
    return df.join(ex, F.col(col) == F.col("_excluded_id"), "left_anti")


def extract_events(product_events: DataFrame, excluded: DataFrame, mobile_lib: str,
                   observation: Observation | None = None) -> DataFrame:
    """Parsed mobile events with a session id, excluded ids removed.

    ``observation`` (optional) collects, in the same pass, the number of
    events read and of malformed ``properties`` (D16).
    """
    return exclude_ids(mobile_events(product_events, mobile_lib, observation), excluded)


def mobile_events(product_events: DataFrame, mobile_lib: str, observation: Observation | None = None) -> DataFrame:
    """Parsed mobile events with a session id, excluded ids still among them."""
    parsed = parse_properties(product_events, flag_malformed=observation is not None)
    if observation is not None:
        parsed = parsed.observe(observation, F.count(F.lit(1)).alias("events_read"),
                                F.count_if("properties_malformed").alias("malformed_properties"))
        parsed = parsed.drop("properties_malformed")
    return parsed.where((F.col("lib") == F.lit(mobile_lib)) & F.col("session_id").isNotNull())


def session_behaviour(events: DataFrame) -> DataFrame:
    """A1-A3: per-session first ids/geo, behaviour flags and touch counts."""
    order = (F.col("timestamp").isNull(), F.col("timestamp"))
    touches = F.count("touch_x") + F.count("touch_y")
    return events.groupBy("session_id").agg(
        first_non_null("distinct_id", *order, F.col("distinct_id")).alias("distinct_id"),
        first_non_null("city", *order, F.col("city")).alias("city"),
        first_non_null("country", *order, F.col("country")).alias("country"),
        *[F.bool_or(pred).alias(name) for name, pred in flags.event_flags("event_name").items()],
        F.bool_or(flags.visited_discover("screen_name")).alias("visited_discover"),
        (touches > 0).alias("scrolled"),
        touches.cast("long").alias("scroll_event_count"),
    )


BEHAVIOUR_FLAGS = ["viewed_event", "joined_event", "invited_someone", "enabled_contacts", "clicked_invite",
                   "started_quiz", "completed_quiz", "visited_discover"]


def event_state(events: DataFrame) -> DataFrame:
    """A1-A3 as a state that can be merged: one row per (session_id, distinct_id)
    of ``mobile_events``.

    ``seen``, ``city`` and ``country`` are the smallest (no time, time[, value])
    of their rows, flags are ORed and touches added up. ``distinct_id`` is part of
    the key, so the exclusion list (P3) can still be applied to the state.
    """
    time = [F.col("timestamp").isNull().alias("no_time"), F.col("timestamp").alias("time")]
    valued = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(*time, F.col(c).alias("value")))).alias(c)
    return events.groupBy("session_id", "distinct_id").agg(
        F.min(F.struct(*time)).alias("seen"), valued("city"), valued("country"),
        *[F.bool_or(pred).alias(name) for name, pred in flags.event_flags("event_name").items()],
        F.bool_or(flags.visited_discover("screen_name")).alias("visited_discover"),
        (F.count("touch_x") + F.count("touch_y")).cast("long").alias("touches"))


def merge_event_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """The state of both frames' events: minima, ORs and sums, no event is read again."""
    return old.unionByName(new).groupBy("session_id", "distinct_id").agg(
        *[F.min(c).alias(c) for c in ("seen", "city", "country")],
        *[F.bool_or(c).alias(c) for c in BEHAVIOUR_FLAGS], F.sum("touches").cast("long").alias("touches"))


def behaviour_of_state(state: DataFrame, excluded: DataFrame) -> DataFrame:
    """``session_behaviour`` from an ``event_state``, the exclusion list applied."""
    first_id = F.min(F.when(F.col("distinct_id").isNotNull(), F.struct("seen", "distinct_id")))
    return exclude_ids(state, excluded).groupBy("session_id").agg(
        first_id.getField("distinct_id").alias("distinct_id"),
        *[F.min(c).getField("value").alias(c) for c in ("city", "country")],
        *[F.bool_or(c).alias(c) for c in BEHAVIOUR_FLAGS],
        (F.sum("touches") > 0).alias("scrolled"), F.sum("touches").cast("long").alias("scroll_event_count"))


def attach_metadata(behaviour: DataFrame, sessions: DataFrame, excluded: DataFrame) -> DataFrame:
    """P5 + J1: session metadata (excluded ids removed) by (session_id, distinct_id)."""
    meta = exclude_ids(sessions.select("session_id", F.col("distinct_id").alias("_meta_id"), *META_COLS),
                       excluded, "_meta_id")
    cond = [behaviour.session_id == meta.session_id, behaviour.distinct_id == meta._meta_id]
    return behaviour.join(meta, cond, "left").drop(meta.session_id).drop("_meta_id")


def dedupe_users(users: DataFrame) -> DataFrame:
    """One user per (fullName, phoneNumber) (null keys equal), keeping the
    first by username then email ascending, nulls last (then user_id)."""
    order = [F.col("username").isNull(), F.col("username"), F.col("email").isNull(),
             F.col("email"), F.col("user_id")]
    return keep_first(users, ["fullName", "phoneNumber"], order,
                      [c for c in USER_COLS if c not in ("fullName", "phoneNumber")]).select(*USER_COLS)


def match_users(sessions: DataFrame, users: DataFrame, deduped: bool = False) -> DataFrame:
    """J2 + J3: attach a user by phone; rows without a phone match retry by
    user id. Adds ``match_rank`` (0 phone, 1 id, null none). ``deduped``: W1 is done."""
    u = users if deduped else dedupe_users(users)
    by_phone = u.select(*[F.col(c).alias(f"_p_{c}") for c in USER_COLS])
    by_id = u.select(*[F.col(c).alias(f"_i_{c}") for c in USER_COLS])
    j = (sessions.join(by_phone, F.col("distinct_id") == F.col("_p_phoneNumber"), "left")
         .join(by_id, F.col("_p_user_id").isNull() & (F.col("distinct_id") == F.col("_i_user_id")), "left"))
    phone_hit = F.col("_p_user_id").isNotNull()
    picked = [F.when(phone_hit, F.col(f"_p_{c}")).otherwise(F.col(f"_i_{c}")).alias(c) for c in USER_COLS]
    rank = F.when(phone_hit, F.lit(0)).when(F.col("_i_user_id").isNotNull(), F.lit(1)).alias("match_rank")
    keep = [c for c in sessions.columns if c not in USER_COLS]
    return j.select(*keep, *picked, rank)


def not_idle() -> Column:
    """Keep unless duration == 0 and autocapture == 0 (null counts keep, D18)."""
    return ~(F.coalesce(F.col("session_duration") == 0, F.lit(False))
             & F.coalesce(F.col("autocapture_count") == 0, F.lit(False)))


def created_during(intervals: DataFrame, app_events: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """For distinct (user_id, start_timestamp, end_timestamp), whether the
    user has an app event with ``start <= createdAt <= end``."""
    s, e = F.col("start_timestamp"), F.col("end_timestamp")
    iv = (intervals.select("user_id", "start_timestamp", "end_timestamp")
          .where(F.col("user_id").isNotNull() & s.isNotNull() & e.isNotNull() & (s <= e)))   # others hold nothing
    return with_created(iv, app_events, bucket_seconds).distinct()


def with_created(sessions: DataFrame, app_events: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """``sessions`` with ``created_event``: has the row's user an app event with
    ``start_timestamp <= createdAt <= end_timestamp``? False if any of these is null.

    Exact and pair-free, one row per session however long it is: sessions (at
    their start) and events are merged into one stream, and a session holds an
    event iff the user's first event from its start on is not after its end.
    That is the next event inside the (user, bucket of time) or else the first
    one of the user's later buckets, taken over the buckets that have a row at
    all. Groups are (user, bucket), small even for the heaviest user, and one
    row per bucket of a user for the later buckets.
    """
    b_us = int(bucket_seconds) * 1_000_000
    bucket_of = lambda c: F.floor(F.unix_micros(c) / F.lit(b_us)).cast("long")
    cols = [F.col(f"`{c}`") for c in sessions.columns]
    starts = sessions.select(F.struct(*cols).alias("_row"), F.col("user_id").alias("_u"), bucket_of(F.col("start_timestamp")).alias("_b"),
                             F.col("start_timestamp").alias("_t"), F.lit(0).alias("_o"), F.lit(None).cast("timestamp").alias("_at"))
    ev = app_events.where(F.col("user_id").isNotNull() & F.col("createdAt").isNotNull())
    points = ev.select(F.lit(None).cast(starts.schema["_row"].dataType).alias("_row"), F.col("user_id").alias("_u"),
                       bucket_of(F.col("createdAt")).alias("_b"), F.col("createdAt").alias("_t"), F.lit(1).alias("_o"), F.col("createdAt").alias("_at"))
    # Events at the instant of a start sort after it, and so are from the start on.
    onward = Window.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    inside = starts.unionByName(points).withColumn("_next", F.min("_at").over(onward.partitionBy("_u", "_b").orderBy("_t", "_o"))) \
        .where(F.col("_o") == 0)
    per_bucket = starts.select("_u", "_b", "_at").unionByName(points.select("_u", "_b", "_at")).where(F.col("_u").isNotNull() & F.col("_b").isNotNull()) \
        .groupBy("_u", "_b").agg(F.min("_at").alias("_first"))
    after = Window.rowsBetween(1, Window.unboundedFollowing)
    later = per_bucket.select("_u", "_b", F.min("_first").over(after.partitionBy("_u").orderBy("_b")).alias("_later"))
    held = F.coalesce(F.coalesce("_next", "_later") <= F.col("_row.end_timestamp"), F.lit(False))
    return inside.join(later, ["_u", "_b"], "left").select(
        *[F.col(f"_row.`{c}`").alias(c) for c in sessions.columns],
        (held & F.col("_u").isNotNull() & F.col("_b").isNotNull()).alias("created_event"))


def sessions_aggregated(product_events: DataFrame, sessions: DataFrame, users: DataFrame,
                        app_events: DataFrame, excluded: DataFrame, mobile_lib: str,
                        stage: Callable[[DataFrame], DataFrame] | None = None,
                        observation: Observation | None = None) -> DataFrame:
    """The sessions_aggregated rows (before conform), with ``match_rank``.

    The matched session rows are read twice (as the output rows and for their
    buckets of time); ``stage`` - e.g. ``lambda df: df.checkpoint()`` in the job -
    materialises them once so the event aggregation is not recomputed.
    """
    events = extract_events(product_events, excluded, mobile_lib, observation)
    return from_behaviour(session_behaviour(events), sessions, users, app_events, excluded, stage)


def from_behaviour(behaviour: DataFrame, sessions: DataFrame, users: DataFrame, app_events: DataFrame,
                   excluded: DataFrame, stage: Callable[[DataFrame], DataFrame] | None = None,
                   few_users: bool = False, deduped: bool = False) -> DataFrame:
    """The sessions_aggregated rows of per-session behaviour. With
    ``few_users`` only the app events of the matched users are shuffled by time;
    ``deduped``: ``users`` are those of ``dedupe_users``."""
    with_meta = attach_metadata(behaviour, sessions, excluded)
    matched = match_users(with_meta, users, deduped).where(F.col("user_id").isNotNull()).where(not_idle())
    if stage is not None:
        matched = stage(matched)
    if few_users:
        app_events = app_events.join(matched.select("user_id").distinct(), "user_id", "left_semi")
    return with_created(matched, app_events)
