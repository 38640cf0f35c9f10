"""Daily activity: the canonical activity spine and the dense user x day grid.

Spine (A9-A12, J5-J8, J10, P12, P13). Each source is reduced first to
``(key, day)`` counts (partial aggregation happens map-side, so a hot key
never travels as raw rows), then two left joins (phone map, id map) map keys
to canonical users and drop excluded ones, and one
``groupBy(user_id, date)`` sums everything. Mapping before the final sum
means a user seen under phone and id on one day gets one row (D7 fixed);
exclusion after canonicalisation catches every id of an excluded person
(D8 fixed). The invite pivot is a fixed list of conditional sums, so an
absent status is 0, never a missing column (D12 fixed), and other statuses
still create their (user, day) row (D13 kept).

Grid (A13, G1, J11-J13). Each user with activity gets one row per day from
``coalesce(date(createdAt), first activity day)`` to ``end_date``. Users whose
start is after ``end_date`` get none (filtered before ``sequence``, D14).
Activity outside the range is dropped (D10). ``createdAt`` and the profile
come from the one-row-per-user profile on every grid row (D9, D11 fixed).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators import identity
from cadence.schemas import ACTIVITY_COUNTS, INVITE_STATUSES


def _zero():
    return F.lit(0).cast("long")


def product_daily_counts(product_events: DataFrame) -> DataFrame:
    """Events per (distinct_id, UTC day); all libs, null keys dropped."""
    return (product_events.where(F.col("distinct_id").isNotNull() & F.col("timestamp").isNotNull())
            .groupBy(F.col("distinct_id").alias("key"), F.to_date("timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("event_count")))


def created_and_invites_daily(app_events: DataFrame, invites: DataFrame) -> DataFrame:
    """A10 + A11: app events and invites per (user_id, day), invites pivoted
    to the fixed statuses with 0 fill."""
    created = (app_events.where(F.col("user_id").isNotNull() & F.col("createdAt").isNotNull())
               .select(F.col("user_id").alias("key"), F.to_date("createdAt").alias("date"),
                       F.lit(1).cast("long").alias("events_created_count"),
                       *[_zero().alias(s) for s in INVITE_STATUSES]))
    inv = (invites.where(F.col("user_id").isNotNull() & F.col("createdAt").isNotNull()
                         & F.col("status").isNotNull())
           .select(F.col("user_id").alias("key"), F.to_date("createdAt").alias("date"),
                   _zero().alias("events_created_count"),
                   *[(F.col("status") == s).cast("long").alias(s) for s in INVITE_STATUSES]))
    return (created.unionByName(inv).groupBy("key", "date")
            .agg(*[F.sum(c).alias(c) for c in ["events_created_count", *INVITE_STATUSES]]))


def activity_spine(product_events: DataFrame, app_events: DataFrame, invites: DataFrame,
                   users: DataFrame, excluded: DataFrame) -> DataFrame:
    """Canonical ``(user_id, date)`` activity with the five counts."""
    return spine_from_counts(product_daily_counts(product_events), app_events, invites, users, excluded)


def merge_product_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Sum two ``product_daily_counts`` frames (incremental refresh state)."""
    return (old.unionByName(new).groupBy("key", "date")
            .agg(F.sum("event_count").cast("long").alias("event_count")))


def spine_from_counts(product_counts: DataFrame, app_events: DataFrame, invites: DataFrame,
                      users: DataFrame, excluded: DataFrame) -> DataFrame:
    """The spine from pre-aggregated product counts ``(key, date, event_count)``;
    identities are resolved here, so stored counts never go stale."""
    prod = product_counts.select(
        "key", "date", F.lit(0).alias("src"), "event_count",
        *[_zero().alias(c) for c in ["events_created_count", *INVITE_STATUSES]])
    other = created_and_invites_daily(app_events, invites).select(
        "key", "date", F.lit(1).alias("src"), _zero().alias("event_count"),
        "events_created_count", *INVITE_STATUSES)
    by_phone, by_id = identity.resolution(users, excluded)
    product = F.col("src") == 0
    phone_hit = product & F.col("phone_target").isNotNull()
    # Two left joins on the key the rows are partitioned by: phone map, then
    # id map (J5, J6, J10); product rows take the phone match when there is one.
    resolved = (prod.unionByName(other).join(by_phone, "key", "left").join(by_id, "key", "left")
                .select(F.when(phone_hit, F.col("phone_target"))
                        .when(product, F.col("id_target"))
                        .otherwise(F.coalesce("id_target", "key")).alias("user_id"),
                        F.when(phone_hit, F.col("phone_excluded"))
                        .otherwise(F.coalesce("id_excluded", F.lit(False))).alias("excluded"),
                        "date", *ACTIVITY_COUNTS)
                .where(F.col("user_id").isNotNull() & ~F.col("excluded")))
    # Rows are already per (key, day), so a partial aggregate before the
    # shuffle would save little; hash-partitioning by user_id instead lets
    # every later per-user step (ranges, grid join, churn window) reuse it.
    return (resolved.repartition("user_id").groupBy("user_id", "date")
            .agg(*[F.sum(c).alias(c) for c in ACTIVITY_COUNTS]))


def user_ranges(spine: DataFrame, profile: DataFrame, end_date: dt.date) -> DataFrame:
    """A13 + J11: per active user, grid start (createdAt day, else first
    activity day) with the profile; users starting after ``end_date`` dropped."""
    first = spine.groupBy("user_id").agg(F.min("date").alias("first_date"))
    return (first.join(profile, "user_id", "left")
            .withColumn("start_date", F.coalesce(F.to_date("createdAt"), F.col("first_date")))
            .where(F.col("start_date") <= F.lit(end_date)))


def activity_in_range(spine: DataFrame, ranges: DataFrame, end_date: dt.date) -> DataFrame:
    """The spine restricted to each user's grid range: exactly the non-zero
    rows of the grid, without materialising the zeros."""
    r = ranges.select("user_id", "start_date")
    return (spine.join(r, "user_id")
            .where((F.col("date") >= F.col("start_date")) & (F.col("date") <= F.lit(end_date)))
            .drop("start_date"))


def daily_grid(ranges: DataFrame, end_date: dt.date) -> DataFrame:
    """G1: one row per user per day in range (range filtered before
    ``sequence``, so it never counts down)."""
    return ranges.select(
        "user_id", "createdAt", "phoneNumber", "fullName", "username", "email",
        F.explode(F.sequence(F.col("start_date"), F.lit(end_date), F.expr("INTERVAL 1 DAY"))).alias("date"))


def user_daily_activity(spine: DataFrame, profile: DataFrame, end_date: dt.date,
                        ranges: DataFrame | None = None) -> DataFrame:
    """The dense grid with activity counts (0 on idle days) and profile.
    ``ranges`` may be passed when already computed (``user_ranges``)."""
    if ranges is None:
        ranges = user_ranges(spine, profile, end_date)
    # Gap expansion: an active day stands for itself and the empty days up to the
    # user's next one, the first for those before it, too; a user without a day in
    # range has one row for all. Nothing is joined on (user, date).
    day = F.col("date")
    rows = ranges.drop("first_date").join(
        spine.select(F.col("user_id").alias("_user"), "date", *ACTIVITY_COUNTS),
        (F.col("user_id") == F.col("_user")) & (day >= F.col("start_date")) & (day <= F.lit(end_date)), "left").drop("_user")
    by_day = Window.partitionBy("user_id").orderBy("date")
    first = F.lag("date").over(by_day).isNull()
    rows = rows.withColumn("_from", F.when(first, F.col("start_date")).otherwise(day)) \
        .withColumn("_to", F.coalesce(F.date_sub(F.lead("date").over(by_day), 1), F.lit(end_date)))
    out = rows.withColumn("_day", F.explode(F.sequence(F.col("_from"), F.col("_to"), F.expr("INTERVAL 1 DAY"))))
    return out.select("user_id", F.col("_day").alias("date"),
                      *[F.when(F.col("_day") == day, F.col(c)).otherwise(_zero()).alias(c) for c in ACTIVITY_COUNTS],
                      "createdAt", "phoneNumber", "fullName", "username", "email")


def build(product_events: DataFrame, app_events: DataFrame, invites: DataFrame,
          users: DataFrame, excluded: DataFrame, end_date: dt.date) -> dict[str, DataFrame]:
    """All daily-activity frames from the raw inputs."""
    spine = activity_spine(product_events, app_events, invites, users, excluded)
    profile = identity.user_profile(identity.user_lookup(users))
    ranges = user_ranges(spine, profile, end_date)
    return {
        "spine": spine,
        "profile": profile,
        "ranges": ranges,
        "in_range": activity_in_range(spine, ranges, end_date),
        "daily": user_daily_activity(spine, profile, end_date),
    }
