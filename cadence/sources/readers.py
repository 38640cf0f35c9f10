"""Readers for the five inputs.

Each input is read with its explicit schema and projected to the columns the
engine uses, so the parquet scan reads only those (column pruning) and the
``since`` predicate on product events reaches the scan (``PushedFilters``).
A source may be a parquet path or a catalog table name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence import schemas
from cadence.functions.conform import utc_literal


def read_source(spark: SparkSession, source: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read input ``name`` (a key of ``schemas.INPUTS``) from a path or table,
    projecting and casting to the input schema."""
    schema = schemas.INPUTS[name]
    if "/" in source or ":" in source:
        raw = spark.read.format(fmt).load(source)
    else:
        raw = spark.read.table(source)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def since_filter(product_events: DataFrame, since: dt.datetime | None) -> DataFrame:
    """``timestamp >= since``; ``None`` is a full load."""
    if since is None:
        return product_events
    return product_events.where(F.col("timestamp") >= utc_literal(since))


def cap_rows(df: DataFrame, n: int | None, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """The optional row cap for trial runs. With ``order_by`` the capped
    rows are repeatable (a top-n by that order); without, any n rows."""
    if n is None:
        return df
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(int(n))


def read_inputs(spark: SparkSession, sources: dict[str, str], since: dt.datetime | None = None,
                limit: int | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All inputs; ``since`` applies to product events only, ``limit``
    to every source (as the reference's trial-run option does) but never to the
    exclusion list, without which excluded people would come back."""
    out = {}
    for name in schemas.INPUTS:
        if name not in sources:
            continue
        df = read_source(spark, sources[name], name, fmt)
        if name == "product_events":
            df = since_filter(df, since)
        out[name] = df if name == "excluded" else cap_rows(df, limit)
    return out
