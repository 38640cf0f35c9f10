"""Reduced event history by day (S1, S7): a dated run over stored tables equals a full load.

Product events are kept reduced, per UTC day: the mergeable behaviour of each
(session, distinct_id) (``sessions.event_state``) and the counts of each distinct_id, in
two tables partitioned by day. A run with ``since`` reads only the events from
that day on, replaces the partitions of these days, whatever they held before,
and derives the four outputs from the whole reduced history; without ``since`` it
replaces all days. So late, corrected and withdrawn events are taken up by reading
their days again, and the JSON of older days is never read.

Every day that a run replaces gets a row without a key in each table: it marks the
day as read, and takes the place of rows that a day no longer has. Events without a
timestamp have a partition of their own, which only a run without ``since``
replaces, as only that one reads them. A partition is swapped when all rows of
the run are written; a run that fails leaves days old or new, and its rerun makes
them new.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.conform import utc_literal
from cadence.operators import activity, sessions
from cadence.params import Params
from cadence.plans import incremental
from cadence.plans.pipeline import Inputs

TABLES = ("events", "counts")
# The partition of events without a timestamp.
NO_DAY = "0001-01-01"


@dataclass
class History:
    """The stored tables of all days."""
    events: DataFrame
    counts: DataFrame

    def behaviour(self) -> DataFrame:
        """The state of all days, one row per (session_id, distinct_id)."""
        rows = self.events.where(F.col("session_id").isNotNull()).drop("day")
        return sessions.merge_event_states(rows, rows.limit(0))

    def product_counts(self) -> DataFrame:
        return self.counts.where(F.col("key").isNotNull()).select("key", F.col("day").alias("date"), "event_count")


def _day() -> Column:
    return F.coalesce(F.to_date("timestamp"), F.lit(NO_DAY).cast("date"))


def reduced(product_events: DataFrame, p: Params) -> dict[str, DataFrame]:
    """The two tables' rows of some events. A session's events of one day share a row."""
    events = sessions.mobile_events(product_events, p.mobile_lib)
    states = sessions.event_state(events.withColumn("session_id", F.struct(F.col("session_id").alias("id"), _day().alias("day"))))
    return {"events": states.withColumn("day", F.col("session_id.day")).withColumn("session_id", F.col("session_id.id")),
            "counts": activity.product_daily_counts(product_events).withColumnRenamed("date", "day")}


def since_day(p: Params) -> dt.date | None:
    return None if p.since is None else p.since.date()


def _schema(table: str) -> T.StructType:
    fields = [f for f in T.StructType.fromDDL(incremental.STATE_SCHEMAS[table]).fields if f.name != "date"]
    return T.StructType([*fields, T.StructField("day", T.DateType())])


def read(spark: SparkSession, folder: str) -> History:
    return History(**{t: spark.read.schema(_schema(t)).parquet(f"{folder.rstrip('/')}/{t}") for t in TABLES})


def held_days(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The days of a stored table (from the names of its partitions)."""
    try:
        return spark.read.schema(_schema(table)).parquet(f"{folder.rstrip('/')}/{table}").select("day").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "day date")


def replace_days(spark: SparkSession, folder: str, product_events: DataFrame, p: Params) -> History:
    """Replace the days from ``p.since`` on (all without it) by ``product_events``; of these only
    the events from that day on are read."""
    start = since_day(p)
    if start is not None:
        product_events = product_events.where(F.col("timestamp") >= utc_literal(dt.datetime.combine(start, dt.time())))
    for table, rows in reduced(product_events, p).items():
        schema = _schema(table)
        days = held_days(spark, folder, table).unionByName(spark.createDataFrame([(p.end_date,)], "day date"))
        if start is not None:
            days = days.where(F.col("day") >= F.lit(start))
        marks = days.distinct().select(*[F.col("day") if f.name == "day" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        rows = rows.select(*schema.fieldNames()).unionByName(marks)
        # One writer per day and a share of its rows, so a day is not one task.
        rows.repartition("day", F.pmod(F.xxhash64(F.col(schema.fieldNames()[0])), F.lit(64))) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{folder.rstrip('/')}/{table}")
    return read(spark, folder)


def spine(held: History, inp: Inputs) -> DataFrame:
    """The activity spine from the history's counts."""
    return incremental.spine_from_state(held.product_counts(), inp)


def sessions_aggregated(held: History, inp: Inputs, stage=None) -> DataFrame:
    """The sessions_aggregated rows from the history (before conform)."""
    return sessions.from_behaviour(sessions.behaviour_of_state(held.behaviour(), inp.excluded), inp.sessions, inp.users,
                                   inp.app_events, inp.excluded, stage)
