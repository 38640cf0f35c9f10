"""Churn state per user for app activity and business activity.

A day is app-active when ``event_count > 0`` and biz-active when
``events_created_count + accepted + invited + rejected > 0`` (nulls as 0).
Per kind: first/last active day, days since the last one, state
(``active`` within the threshold, else ``churned``; ``reactivated`` when
active after at least one gap over the threshold), churn date
(last active + threshold when churned) and the number of such gaps.
Kinds a user never had are ``never_active``; users with neither are absent.

Plan: one window partitioned by ``user_id`` (ordered by date) finds, for
each active day, the previous active day of the same kind; one
``groupBy(user_id)`` on the same partitioning yields everything else, so the
whole operator costs a single shuffle. The per-user group is bounded by the
number of days in range. Zero rows never matter, so the sparse in-range
spine gives the same result as the dense grid.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("app", "biz")


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def activity_flags(activity: DataFrame) -> DataFrame:
    """Per-row app / biz activity flags."""
    return activity.select(
        "user_id", "date", "event_count", "events_created_count", "accepted",
        (_z("event_count") > 0).alias("app"),
        ((_z("events_created_count") + _z("accepted") + _z("invited") + _z("rejected")) > 0).alias("biz"))


def activity_gaps(activity: DataFrame) -> DataFrame:
    """For each active day of each kind, days since the previous active
    day of that kind (0 for the first)."""
    flagged = activity_flags(activity)
    w = Window.partitionBy("user_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    cols = []
    for kind in KINDS:
        prev = F.last(F.when(F.col(kind), F.col("date")), ignorenulls=True).over(w)
        cols.append(F.when(F.col(kind), F.coalesce(F.datediff("date", prev), F.lit(0)))
                    .cast("long").alias(f"{kind}_gap"))
    return flagged.select("*", *cols)


def churn_state(activity: DataFrame, end_date: dt.date, threshold_days: int = 14) -> DataFrame:
    """The user_churn_state columns (without ``etl_loaded_at``)."""
    thr = int(threshold_days)
    gaps = activity_gaps(activity)
    aggs = []
    for kind in KINDS:
        d = F.when(F.col(kind), F.col("date"))
        aggs += [F.min(d).alias(f"first_{kind}"), F.max(d).alias(f"last_{kind}"),
                 F.count_if(F.col(f"{kind}_gap") > thr).alias(f"{kind}_gaps")]
    aggs += [F.coalesce(F.sum("events_created_count"), F.lit(0)).cast("long").alias("total_events_created"),
             F.coalesce(F.sum("accepted"), F.lit(0)).cast("long").alias("total_events_attended"),
             F.coalesce(F.sum("event_count"), F.lit(0)).cast("long").alias("total_app_interactions")]
    per_user = (gaps.groupBy("user_id").agg(*aggs)
                .where(F.col("last_app").isNotNull() | F.col("last_biz").isNotNull()))

    end = F.lit(end_date)
    out = [F.col("user_id")]
    for kind in KINDS:
        last = F.col(f"last_{kind}")
        since = F.datediff(end, last)
        churned = since > thr
        state = (F.when(last.isNull(), F.lit("never_active"))
                 .when(churned, F.lit("churned"))
                 .when(F.col(f"{kind}_gaps") > 0, F.lit("reactivated"))
                 .otherwise(F.lit("active")))
        out += [state.alias(f"{kind}_churn_state"),
                F.when(churned, F.date_add(last, thr)).alias(f"{kind}_churn_date"),
                F.when(last.isNull(), F.lit(0)).otherwise(F.col(f"{kind}_gaps")).cast("long")
                .alias(f"{kind}_times_churned"),
                since.cast("long").alias(f"days_since_last_{kind}_activity"),
                F.col(f"first_{kind}").alias(f"first_{kind}_active_date"),
                last.alias(f"last_{kind}_active_date")]
    out += ["total_events_created", "total_events_attended", "total_app_interactions"]
    return per_user.select(*out)
