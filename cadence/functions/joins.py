"""Join helpers: size-checked broadcast and keep-first by ordering.

``keep_first`` is the scale-safe form of "sort, then drop duplicates keeping
the first": a ``groupBy`` with ``min(struct(order..., payload...))``. It is a
plain aggregate, so a hot key is reduced map-side (partial aggregation)
before the shuffle instead of being sorted whole inside one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sides at or under this many rows may be broadcast.
BROADCAST_MAX_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``df`` is proven to hold at most ``max_rows`` rows, checked with
    ``limit(max_rows + 1).count()`` (a scan that stops early)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it is proven to hold at most ``max_rows``;
    above it the plain frame is returned and the planner/AQE pick a shuffle
    join from runtime statistics."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               payload: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    ``order`` columns must make the choice total (end them with a unique
    column); ``payload`` columns are carried from the chosen row.
    """
    order_fields = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    pick = F.min(F.struct(*order_fields, *[F.col(c) for c in payload])).alias("_pick")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in payload])


def first_non_null(value: str | Column, *order: Column) -> Column:
    """The value of the row with the smallest ``order`` among rows where the
    value is not null (``min_by`` ignores rows whose ordering is null)."""
    v = F.col(value) if isinstance(value, str) else value
    key = F.struct(*order) if len(order) > 1 else order[0]
    return F.min_by(v, F.when(v.isNotNull(), key))
