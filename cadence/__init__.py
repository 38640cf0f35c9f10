"""cadence: product-analytics tables as plain Spark DataFrame transforms.

Five inputs (product events, session metadata, users, app events, invites)
become four outputs (sessions_aggregated, people_aggregated,
user_daily_activity, user_churn_state). Every operator is a
``DataFrame -> DataFrame`` function built from Spark SQL built-ins; I/O and
job orchestration live in :mod:`cadence.sources` and :mod:`cadence.plans`.
"""

from cadence.params import Params

__all__ = ["Params"]
