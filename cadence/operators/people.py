"""People: sessions_aggregated -> one row per user.

One ``groupBy(user_id)`` of declarative aggregates (partial aggregation
map-side) plus the exact median, joined on ``user_id``. Profile columns take
the first non-null value in the order the sessions stage produces: phone
matches before id matches, then ``session_id`` (D15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.joins import first_non_null
from cadence.functions.stats import exact_median
from cadence.schemas import PEOPLE_FLAG_SUMS

DURATION_DECIMAL = "decimal(18,6)"
PROFILE = ["fullName", "phoneNumber", "username", "email", "contactAccessGranted",
           "businessUser", "createdAt", "city", "country"]
COUNTS = {"scroll_event_count": ("total_scrolls", "avg_scrolls_per_session", "max_scrolls_per_session"),
          "autocapture_count": ("total_autocaptures", "avg_autocaptures_per_session",
                                "max_autocaptures_per_session"),
          "screen_count": ("total_screens", "avg_screens_per_session", "max_screens_per_session")}


def _match_rank():
    # 0 when the session matched its user by phone, else 1 (derivable because
    # a phone match always wins over an id match).
    return F.when(F.col("distinct_id") == F.col("phoneNumber"), F.lit(0)).otherwise(F.lit(1))


def people_aggregated(sessions_agg: DataFrame) -> DataFrame:
    """The people_aggregated columns (without ``etl_loaded_at``)."""
    s = sessions_agg.withColumn("_rank", _match_rank())
    # Row order of the sessions stage: phone matches first, then session id;
    # one session fanned out to several rows of a user comes in the users'
    # (fullName, phoneNumber, username, email) order, nulls last.
    order = [F.col("_rank"), F.col("session_id"), F.col("start_timestamp").isNull(), F.col("start_timestamp")]
    for c in ("fullName", "phoneNumber", "username", "email"):
        order += [F.col(c).isNull(), F.col(c)]
    s = s.withColumn("_order", F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)]))   # built once a row, not per column
    dur = F.col("session_duration")
    # Durations are summed exactly (decimal, microsecond precision), so the
    # total and mean do not depend on partitioning or summation order.
    dur_sum = F.sum(dur.cast(DURATION_DECIMAL))
    aggs = [
        F.count("session_id").alias("total_sessions"),
        (dur_sum.cast("double") / F.count(dur)).alias("avg_session_duration"),
        F.coalesce(dur_sum.cast("double"), F.lit(0.0)).alias("total_session_duration"),
        F.min(dur).alias("min_session_duration"),
        F.max(dur).alias("max_session_duration"),
        F.stddev_samp(dur).alias("std_session_duration"),
        *[F.count_if(F.col(c)).alias(f"{c}_sum") for c in PEOPLE_FLAG_SUMS],
    ]
    for c, (tot, avg, mx) in COUNTS.items():
        aggs += [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(tot), F.avg(c).alias(avg),
                 F.max(c).cast("long").alias(mx)]
    aggs += [F.min("start_timestamp").alias("first_session_date"),
             F.max("start_timestamp").alias("last_session_date")]
    aggs += [first_non_null(c, F.col("_order")).alias(c) for c in PROFILE]
    per_user = s.groupBy("user_id").agg(*aggs)
    median = exact_median(s, "user_id", "session_duration", "median_session_duration")

    days = (F.unix_micros("last_session_date") - F.unix_micros("first_session_date")) / 86400e6
    engaged = sum((F.col(f"{c}_sum") for c in ("created_event", "viewed_event", "joined_event", "scrolled")),
                  F.lit(0))
    return (per_user.join(median, "user_id", "left")
            .withColumn("days_since_first_session", days)
            .withColumn("sessions_per_day", F.col("total_sessions") / (F.col("days_since_first_session") + 1))
            .withColumn("engagement_score", engaged / F.col("total_sessions")))
