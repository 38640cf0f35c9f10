"""Incremental refresh (I1) as a Structured Streaming job.

New product-event files are picked up by a file-source stream whose
checkpoint records which files were processed, so "only data newer than the
last run" is exactly the set of files the stream has not seen. Each
micro-batch (``foreachBatch``) is merged into the stored state by
``cadence.plans.incremental.refresh``, which also compares the side inputs with
the state; ``catch_up`` does so when no event file is new.

State versions take turns in a ring of ``SLOTS`` folders, so the state never
grows by old copies: version n overwrites the slot of version n - SLOTS. Its
tables are written first and its one-row commit (version, epoch) last; the newest
commit names the state. A version that fails half-way has no commit of its own
and leaves the slots of the versions before it alone. A replayed batch starts
from the newest version of an earlier epoch, as it did the first time.
The state folder lives under ``spark.checkpoint.dir`` unless given. Run with
``trigger(availableNow=True)`` for a daily job, or a processing-time trigger
for a continuous one. The grid and churn are derived from the spine (they
depend on ``end_date``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cadence import schemas
from cadence.operators import activity, identity
from cadence.params import Params
from cadence.plans import incremental, pipeline
from cadence.plans.incremental import State
from cadence.plans.pipeline import Inputs
from cadence.session import checkpoint_dir, prepare
from cadence.sources import readers

SLOTS = 3
_COMMIT = "version long, epoch long"


def _slot(state_dir: str, version: int, table: str) -> str:
    return f"{state_dir.rstrip('/')}/slot{version % SLOTS}/{table}"


def commits(spark: SparkSession, state_dir: str) -> list[tuple[int, int]]:
    """(version, epoch) of the versions held, oldest first."""
    found = []
    for k in range(SLOTS):
        try:
            found += [tuple(r) for r in spark.read.schema(_COMMIT).parquet(_slot(state_dir, k, "commit")).collect()]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return sorted(found)


def read_state(spark: SparkSession, state_dir: str, version: int) -> State:
    """The state of a version (-1: empty)."""
    if version < 0:
        return incremental.empty_state(spark)
    schema = lambda s: s if isinstance(s, T.StructType) else T.StructType.fromDDL(s)
    return State(**{name: spark.read.schema(schema(incremental.STATE_SCHEMAS[name])).parquet(_slot(state_dir, version, name))
                    for name in State.names()})


def latest(spark: SparkSession, state_dir: str) -> State | None:
    """The newest state, None before the first batch."""
    held = commits(spark, state_dir)
    return read_state(spark, state_dir, held[-1][0]) if held else None


def _advance(spark: SparkSession, sources: dict[str, str], state_dir: str, p: Params, delta: DataFrame, parent: int, epoch: int) -> bool:
    """Write the version after ``parent``; False if nothing has changed."""
    inp = Inputs.of({**readers.read_inputs(spark, {k: v for k, v in sources.items() if k != "product_events"}), "product_events": delta})
    version = parent + 1

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = _slot(state_dir, version, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    if incremental.refresh(read_state(spark, state_dir, parent), inp, delta, p, keep) is None:
        return False
    spark.createDataFrame([(version, epoch)], _COMMIT).coalesce(1).write.mode("overwrite").parquet(_slot(state_dir, version, "commit"))
    return True


def _batch_fn(sources: dict[str, str], state_dir: str, p: Params):
    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        prepare(spark)
        held = commits(spark, state_dir)
        if any(e >= epoch for _, e in held):   # committed before the stream could note it
            return
        # Read twice: keep the micro-batch for its duration (a lost block is
        # recomputed from the batch's files).
        delta = batch.select(*schemas.PRODUCT_EVENTS.fieldNames()).persist()
        _advance(spark, sources, state_dir, p, delta, held[-1][0] if held else -1, epoch)
        delta.unpersist()
    return apply


def start(spark: SparkSession, sources: dict[str, str], p: Params, state_dir: str | None = None,
          available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental stream over ``sources['product_events']`` (a
    folder of parquet files). Returns the running query."""
    prepare(spark)
    state_dir = state_dir or f"{checkpoint_dir(spark).rstrip('/')}/incremental-state"
    stream = spark.readStream.schema(schemas.PRODUCT_EVENTS).parquet(sources["product_events"])
    w = (stream.writeStream.foreachBatch(_batch_fn(sources, state_dir, p))
         .option("checkpointLocation", f"{state_dir}/_stream"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 hour")
    return w.start()


def catch_up(spark: SparkSession, sources: dict[str, str], p: Params, state_dir: str) -> bool:
    """Bring the newest state up to changed side inputs, without new events. Not while the
    stream runs. False if there is no state or nothing it depends on has changed."""
    held = commits(spark, state_dir)
    if not held:
        return False
    none = spark.createDataFrame([], schemas.PRODUCT_EVENTS)
    return _advance(spark, sources, state_dir, p, none, *held[-1])


def last_epoch(query: StreamingQuery) -> int:
    """The last batch id this run processed with data (-1 if it found no new
    files; progress entries of empty triggers are ignored)."""
    done = [int(pr["batchId"]) for pr in query.recentProgress if pr.get("numInputRows", 0) > 0]
    return max(done) if done else -1


def daily_from_state(state: State, inp: Inputs, p: Params) -> dict[str, DataFrame]:
    """user_daily_activity and user_churn_state from the stored counts, app events and
    invites (whole tables), resolved with the current users."""
    spine = incremental.spine_from_state(state.counts, inp).checkpoint()
    profile = identity.user_profile(identity.user_lookup(inp.users))
    ranges = activity.user_ranges(spine, profile, p.end_date).checkpoint()
    frames = {"daily": activity.user_daily_activity(spine, profile, p.end_date, ranges),
              "in_range": activity.activity_in_range(spine, ranges, p.end_date)}
    return {"user_daily_activity": pipeline.user_daily_activity(frames, p),
            "user_churn_state": pipeline.user_churn_state(frames["in_range"], p)}
