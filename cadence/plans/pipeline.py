"""The four output tables as lazy DataFrames over the five inputs.

Nothing here executes; the job runner (``cadence.plans.job``) decides what
to write, and where to cut lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cadence import schemas
from cadence.functions.conform import conform
from cadence.operators import activity, churn, people, sessions
from cadence.params import Params


@dataclass
class Inputs:
    product_events: DataFrame
    sessions: DataFrame
    users: DataFrame
    app_events: DataFrame
    invites: DataFrame
    excluded: DataFrame

    @staticmethod
    def of(d: dict[str, DataFrame]) -> "Inputs":
        return Inputs(**{k: d[k] for k in ("product_events", "sessions", "users", "app_events",
                                           "invites", "excluded")})


def sessions_aggregated(inp: Inputs, p: Params, stage=None, observation=None) -> DataFrame:
    df = sessions.sessions_aggregated(inp.product_events, inp.sessions, inp.users, inp.app_events,
                                      inp.excluded, p.mobile_lib, stage=stage, observation=observation)
    return conform(df, schemas.SESSIONS_AGGREGATED, p.run_ts)


def people_aggregated(sessions_agg: DataFrame, p: Params) -> DataFrame:
    return conform(people.people_aggregated(sessions_agg), schemas.PEOPLE_AGGREGATED, p.run_ts)


def daily_frames(inp: Inputs, p: Params) -> dict[str, DataFrame]:
    return activity.build(inp.product_events, inp.app_events, inp.invites, inp.users, inp.excluded,
                          p.end_date)


def user_daily_activity(frames: dict[str, DataFrame], p: Params) -> DataFrame:
    return conform(frames["daily"], schemas.USER_DAILY_ACTIVITY, p.run_ts)


def user_churn_state(activity_df: DataFrame, p: Params) -> DataFrame:
    """Churn from any activity frame: the sparse in-range spine (what the
    job uses) or the dense daily grid (same result)."""
    return conform(churn.churn_state(activity_df, p.end_date, p.threshold_days),
                   schemas.USER_CHURN_STATE, p.run_ts)
