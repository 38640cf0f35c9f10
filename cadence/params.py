"""Job parameters shared by every stage."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the reference for identical results.
# The client library name that marks mobile product events, and the default
# number of idle days after which a user counts as churned.
MOBILE_LIB = "posthog-react-native"
DEFAULT_THRESHOLD_DAYS = 14


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Params:
    """One run's parameters.

    ``end_date`` closes the daily grid and anchors churn; ``run_ts`` is the
    single ``etl_loaded_at`` value stamped on every output row; ``since``
    restricts product events to ``timestamp >= since`` (None = full load).
    """

    end_date: dt.date = field(default_factory=lambda: _utc_now().date())
    threshold_days: int = DEFAULT_THRESHOLD_DAYS
    mobile_lib: str = MOBILE_LIB
    run_ts: dt.datetime = field(default_factory=_utc_now)
    since: dt.datetime | None = None

    @staticmethod
    def of(end_date: str | dt.date, threshold_days: int = DEFAULT_THRESHOLD_DAYS,
           run_ts: str | dt.datetime | None = None, **kw) -> "Params":
        if isinstance(end_date, str):
            end_date = dt.date.fromisoformat(end_date)
        if isinstance(run_ts, str):
            run_ts = dt.datetime.fromisoformat(run_ts)
        if run_ts is None:
            run_ts = _utc_now()
        return Params(end_date=end_date, threshold_days=threshold_days, run_ts=run_ts, **kw)
