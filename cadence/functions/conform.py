"""Schema conformance (P9), the load stamp (P11) and the REQUIRED-key check.

``conform`` is one projection over the target schema: present columns are
cast, missing ones become a typed literal (False for booleans, NULL
otherwise), null booleans are filled with False, extra columns are dropped
and the order is the schema's. It runs inside the same codegen stage as the
operator that feeds it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utc_literal(ts: dt.datetime) -> Column:
    """A timestamp literal; a value without a zone is UTC, not the driver's zone."""
    return F.lit(ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc))


def _default(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.BooleanType):
        return F.lit(False)
    return F.lit(None).cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType, run_ts: dt.datetime | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``.

    ``etl_loaded_at``, when it is a schema column and ``run_ts`` is given, is
    stamped with that single run timestamp (one value for the whole run).
    """
    present = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name == "etl_loaded_at" and run_ts is not None:
            c = utc_literal(run_ts).cast(field.dataType)
        elif field.name in present:
            c = F.col(field.name).cast(field.dataType)
            if isinstance(field.dataType, T.BooleanType):
                c = F.coalesce(c, F.lit(False))
        else:
            c = _default(field)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def null_key_violations(df: DataFrame, schema: T.StructType) -> Column | None:
    """A predicate that is true on rows breaking a REQUIRED column."""
    req = required_columns(schema)
    if not req:
        return None
    pred = F.col(req[0]).isNull()
    for c in req[1:]:
        pred = pred | F.col(c).isNull()
    return pred


def stamp(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Add ``etl_loaded_at`` = the run timestamp."""
    return df.withColumn("etl_loaded_at", utc_literal(run_ts).cast("timestamp"))
