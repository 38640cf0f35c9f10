"""Print the shuffle skeleton of the job's stages: python tests/plan_report.py [sf_dir]

Plans are taken as a large cluster would start them: AQE off and automatic
broadcasts off (only the size-checked exclusion-list broadcast remains), so
every exchange that would move data at scale is visible.
"""

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadence.operators import activity, churn, identity  # noqa: E402
from cadence.plans import pipeline  # noqa: E402
from cadence.plans.catalog import ORACLE_PARAMS  # noqa: E402
from cadence.plans.pipeline import Inputs  # noqa: E402
from cadence.session import local_session  # noqa: E402
from cadence.sources import adapters, readers  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Window|Generate|Scan parquet|Union|Expand")


def skeleton(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"\*\(\d+\) ", "", line)
        line = re.sub(r"(functions=\[)[^\]]*\]", r"\1...]", line)
        line = re.sub(r"(FileScan parquet \[[^\]]*\]).*(ReadSchema.*)", r"\1 \2", line)
        line = re.sub(r"(output=\[)[^\]]*\]", r"\1...]", line)
        out.append(line.rstrip()[:160])
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=200)
    paths = adapters.materialize(spark, sf, tempfile.mkdtemp(prefix="cadence-plans-"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    p = ORACLE_PARAMS
    inp = Inputs.of(readers.read_inputs(spark, paths))
    spine = activity.activity_spine(inp.product_events, inp.app_events, inp.invites, inp.users, inp.excluded)
    profile = identity.user_profile(identity.user_lookup(inp.users))
    ranges = activity.user_ranges(spine, profile, p.end_date)
    frames = {
        "sessions_aggregated": pipeline.sessions_aggregated(inp, p),
        "people_aggregated (from stored sessions)": pipeline.people_aggregated(
            spark.createDataFrame([], pipeline.schemas.SESSIONS_AGGREGATED), p),
        "activity_spine": spine,
        "user_daily_activity (from the spine)": activity.user_daily_activity(spine, profile, p.end_date),
        "user_churn_state (from the spine)": churn.churn_state(
            activity.activity_in_range(spine, ranges, p.end_date), p.end_date, p.threshold_days),
    }
    for name, df in frames.items():
        lines = skeleton(df)
        n_ex = sum("Exchange hashpartitioning" in line for line in lines)
        print(f"\n### {name}\n\nhash exchanges: {n_ex}\n\n```")
        print("\n".join(lines))
        print("```")


if __name__ == "__main__":
    main()
