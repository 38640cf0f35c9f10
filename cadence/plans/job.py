"""The daily job: five sources in, four tables out.

``python -m cadence.plans.job --sources DIR --target DIR [--end-date D]
[--since TS | --full-load | --incremental STATE_DIR] [--history DIR] [--limit N] [--threshold N]``

Two independent branches run as concurrent Spark jobs:

* sessions -> people: the matched sessions are checkpointed (reliable, to
  ``spark.checkpoint.dir``), being read twice; people read the table that the
  sessions stage has published;
* daily -> churn: the canonical activity spine is checkpointed because it
  feeds both the grid and churn. Churn reads the sparse in-range spine
  rather than the written grid (same result, no zero rows).

A failing stage does not stop the other branch, its dependant is skipped,
and the run reports failure at the end (non-zero exit).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import traceback
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadence import schemas
from cadence.params import DEFAULT_THRESHOLD_DAYS, Params
from cadence.operators import activity
from cadence.functions.conform import conform
from cadence.plans import history, pipeline
from cadence.plans.pipeline import Inputs
from cadence.session import prepare
from cadence.sources import readers, sinks

OUTPUT_TABLES = list(schemas.OUTPUTS)


@dataclass
class StageResult:
    table: str
    status: str  # ok | skipped-empty | failed | skipped
    rows: int = 0
    error: str | None = None
    metrics: dict = field(default_factory=dict)


def _target(targets: dict[str, str] | str, table: str) -> str:
    if isinstance(targets, str):
        return f"{targets.rstrip('/')}/{table}" if ("/" in targets or ":" in targets) else f"{targets}.{table}"
    return targets[table]


def _write(df: DataFrame, targets, table: str, probe: DataFrame | None = None) -> StageResult:
    res = sinks.write_table(df, _target(targets, table), "overwrite", schema=schemas.OUTPUTS[table],
                            probe=probe)
    return StageResult(table, "skipped-empty" if res.skipped else "ok", res.rows_written)


def _failed(table: str, e: BaseException) -> StageResult:
    return StageResult(table, "failed", error="".join(traceback.format_exception_only(type(e), e)).strip())


def _cut(df: DataFrame) -> DataFrame:
    """Lineage cut: a reliable checkpoint in ``spark.checkpoint.dir``."""
    return df.checkpoint(eager=True)


def _sessions_branch(inp: Inputs, p: Params, targets, held: history.History | None = None) -> list[StageResult]:
    out = []
    try:
        seen = Observation("sessions_input")
        if held is None:
            df = pipeline.sessions_aggregated(inp, p, stage=_cut, observation=seen)
        else:
            df = conform(history.sessions_aggregated(held, inp, stage=_cut), schemas.SESSIONS_AGGREGATED, p.run_ts)
        res = _write(df, targets, "sessions_aggregated")
        if res.status == "skipped-empty":  # no sessions, no people
            return [res, StageResult("people_aggregated", "skipped-empty")]
        # The published table is read back: written once, and the lineage cut for people.
        sess = sinks.read_back(df.sparkSession, _target(targets, "sessions_aggregated"))
        # Malformed properties are dropped, and reported; D5: a session
        # matched to several users (shared phone) is kept, and reported.
        res.metrics = dict(seen.get) if held is None else {}
        res.metrics["sessions_with_several_users"] = (
            sess.groupBy("session_id").count().where(F.col("count") > 1).count())
        out.append(res)
    except Exception as e:  # stage isolation
        return [_failed("sessions_aggregated", e), StageResult("people_aggregated", "skipped")]
    try:
        out.append(_write(pipeline.people_aggregated(sess, p), targets, "people_aggregated", probe=sess))
    except Exception as e:
        out.append(_failed("people_aggregated", e))
    return out


def _daily_branch(inp: Inputs, p: Params, targets, held: history.History | None = None) -> list[StageResult]:
    out = []
    try:
        frames = pipeline.daily_frames(inp, p)
        spine = _cut(frames["spine"] if held is None else history.spine(held, inp))
        frames = _rebuild_on(spine, frames, inp, p)
        out.append(_write(pipeline.user_daily_activity(frames, p), targets, "user_daily_activity",
                          probe=frames["ranges"]))
    except Exception as e:
        return [_failed("user_daily_activity", e), StageResult("user_churn_state", "skipped")]
    try:
        # Churn has a row exactly for users with an active day in range.
        active = frames["in_range"].where(_any_activity())
        out.append(_write(pipeline.user_churn_state(frames["in_range"], p), targets, "user_churn_state",
                          probe=active))
    except Exception as e:
        out.append(_failed("user_churn_state", e))
    return out


def _any_activity():
    from pyspark.sql import functions as F
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (z("event_count") + z("events_created_count") + z("accepted") + z("invited") + z("rejected")) > 0


def _rebuild_on(spine: DataFrame, frames: dict, inp: Inputs, p: Params) -> dict:
    """Daily frames re-derived from a checkpointed spine; the per-user ranges
    (read by the grid, churn and the emptiness probe) are cut as well."""
    profile = frames["profile"]
    ranges = _cut(activity.user_ranges(spine, profile, p.end_date))
    return {"spine": spine, "profile": profile, "ranges": ranges,
            "in_range": activity.activity_in_range(spine, ranges, p.end_date),
            "daily": activity.user_daily_activity(spine, profile, p.end_date, ranges)}


def run(spark: SparkSession, sources: dict[str, str], targets: dict[str, str] | str, p: Params,
        limit: int | None = None, fmt: str = "parquet", history_dir: str | None = None) -> list[StageResult]:
    """Run both branches; return one result per output table.

    With ``history_dir`` the product events go through the reduced history kept there
    (``plans.history``): a run with ``p.since`` reads the events of that day and later ones only, and the
    tables still cover all days. Without it such tables would cover only the events
    read, so targets that hold tables of earlier runs are refused: nothing is read or
    written then."""
    prepare(spark)
    if p.since is not None and history_dir is None:
        held = [t for t in OUTPUT_TABLES if sinks.exists(spark, _target(targets, t))]
        if held:
            e = ValueError(f"--since reads only newer events and would overwrite {', '.join(held)} without the older rows; "
                           "use --history, another target, --full-load or --incremental")
            return [_failed(t, e) for t in OUTPUT_TABLES]
    inp = Inputs.of(readers.read_inputs(spark, sources, since=None if history_dir else p.since, limit=limit, fmt=fmt))
    kept = None
    if history_dir is not None:
        try:
            kept = history.replace_days(spark, history_dir, inp.product_events, p)
        except Exception as e:
            return [_failed(t, e) for t in OUTPUT_TABLES]
    with ThreadPoolExecutor(max_workers=2) as pool:
        a = pool.submit(_sessions_branch, inp, p, targets, kept)
        b = pool.submit(_daily_branch, inp, p, targets, kept)
        return a.result() + b.result()


def run_incremental(spark: SparkSession, sources: dict[str, str], targets: dict[str, str] | str,
                    p: Params, state_dir: str) -> list[StageResult]:
    """I1 from the command line: the streaming refresh over new event files
    only (``trigger(availableNow=True)``), one over changed side inputs, then all
    four tables from the newest state. They are written even if no event file is new: the grid and
    churn move on with ``end_date``, app events and invites may be new, and a
    run that ended between the stream and the writes is caught up."""
    from cadence.streaming import incremental as stream
    prepare(spark)
    query = stream.start(spark, sources, p, state_dir=state_dir)
    query.awaitTermination()
    stream.catch_up(spark, sources, p, state_dir)
    state = stream.latest(spark, state_dir)
    if state is None:  # no event file has ever arrived
        return [StageResult(t, "skipped-empty") for t in OUTPUT_TABLES]
    inp = Inputs.of(readers.read_inputs(spark, sources))
    out = []
    for table in ("sessions_aggregated", "people_aggregated"):
        try:
            out.append(_write(getattr(state, table), targets, table))
        except Exception as e:
            out.append(_failed(table, e))
    try:
        daily = stream.daily_from_state(state, inp, p)
        for table in ("user_daily_activity", "user_churn_state"):
            out.append(_write(daily[table], targets, table))
    except Exception as e:
        out += [_failed(t, e) for t in ("user_daily_activity", "user_churn_state")]
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Build the four product-analytics tables.")
    ap.add_argument("--sources", required=True,
                    help="folder with one parquet folder per input (product_events, sessions, users, "
                         "app_events, invites, excluded)")
    ap.add_argument("--target", required=True, help="output folder or database name")
    ap.add_argument("--end-date", default=None, help="last grid day (UTC), default today")
    ap.add_argument("--threshold", type=int, default=DEFAULT_THRESHOLD_DAYS)
    ap.add_argument("--since", default=None, help="only product events at or after this time")
    ap.add_argument("--full-load", action="store_true", help="ignore --since")
    ap.add_argument("--limit", type=int, default=None, help="row cap per source, for trial runs")
    ap.add_argument("--incremental", metavar="STATE_DIR", default=None,
                    help="process only product-event files not seen before (state kept in STATE_DIR)")
    ap.add_argument("--history", metavar="DIR", default=None,
                    help="keep product events reduced by day in DIR; --since then replaces the days from its day on")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("cadence-job").getOrCreate()
    since = None if args.full_load or not args.since else dt.datetime.fromisoformat(args.since)
    p = Params.of(args.end_date or dt.datetime.now(dt.timezone.utc).date(), args.threshold, since=since)
    base = args.sources.rstrip("/")
    sources = {name: f"{base}/{name}" for name in schemas.INPUTS}
    if not (":" in args.target or "/" in args.target):
        sinks.ensure_database(spark, args.target)
    if args.incremental:
        results = run_incremental(spark, sources, args.target, p, args.incremental)
    else:
        results = run(spark, sources, args.target, p, limit=args.limit, history_dir=args.history)
    for r in results:
        print(f"{r.table}: {r.status} rows={r.rows}" + (f" error={r.error}" if r.error else "")
              + (f" metrics={r.metrics}" if r.metrics else ""))
    return 1 if any(r.status in ("failed", "skipped") for r in results) else 0


if __name__ == "__main__":
    sys.exit(main())
