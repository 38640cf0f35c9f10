"""Table-level API: one call per output table, DataFrames in, conformed
DataFrame out (schema, column order, ``etl_loaded_at``).

These are the library entry points for a caller who holds the input frames
(e.g. from ``cadence.sources.readers.read_inputs``); the job runner
(``cadence.plans.job``) adds I/O, lineage cuts and stage isolation.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame

from cadence.params import Params
from cadence.plans import pipeline
from cadence.plans.pipeline import Inputs


def _params(params: Params | None, **overrides) -> Params:
    p = params or Params()
    changes = {k: v for k, v in overrides.items() if v is not None}
    return dataclasses.replace(p, **changes) if changes else p


def sessions_aggregated(product_events: DataFrame, sessions: DataFrame, users: DataFrame,
                        app_events: DataFrame, excluded: DataFrame,
                        params: Params | None = None) -> DataFrame:
    """One row per (session, matched user) with behaviour flags and profile."""
    inp = Inputs(product_events, sessions, users, app_events, None, excluded)  # no invites needed
    return pipeline.sessions_aggregated(inp, _params(params))


def people_aggregated(sessions_agg: DataFrame, params: Params | None = None) -> DataFrame:
    """One row per user from a sessions_aggregated table."""
    return pipeline.people_aggregated(sessions_agg, _params(params))


def user_daily_activity(product_events: DataFrame, app_events: DataFrame, invites: DataFrame,
                        users: DataFrame, excluded: DataFrame, end_date: dt.date | str | None = None,
                        params: Params | None = None) -> DataFrame:
    """The dense user x day activity table up to ``end_date``."""
    if isinstance(end_date, str):
        end_date = dt.date.fromisoformat(end_date)
    p = _params(params, end_date=end_date)
    inp = Inputs(product_events, None, users, app_events, invites, excluded)  # no session metadata needed
    return pipeline.user_daily_activity(pipeline.daily_frames(inp, p), p)


def user_churn_state(daily_activity: DataFrame, threshold_days: int | None = None,
                     end_date: dt.date | str | None = None, params: Params | None = None) -> DataFrame:
    """Churn state per user from a daily activity table (dense grid or any
    frame with ``user_id, date`` and the five activity counts)."""
    if isinstance(end_date, str):
        end_date = dt.date.fromisoformat(end_date)
    p = _params(params, end_date=end_date, threshold_days=threshold_days)
    return pipeline.user_churn_state(daily_activity, p)
