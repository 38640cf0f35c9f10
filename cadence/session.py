"""SparkSession helpers.

The engine needs UTC session time (days are UTC days) and a shared folder for
lineage cuts. On a cluster both come from the submitted configuration; we only
fill in what is unset, which is what happens in tests and local benches.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Session settings the engine relies on for its plans (see ``prepare``).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Joins on (user_id, date) between frames already hash-partitioned by
    # user_id (spine, grid, ranges) then need no extra shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cadence", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CADENCE_DRIVER_MEMORY", "8g")
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="cadence-warehouse-")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session fit for the engine: UTC days, a checkpoint folder.

    Only ``ENGINE_CONF`` is forced (UTC days, co-partitioned joins).
    The checkpoint folder is taken from ``spark.checkpoint.dir`` when the
    cluster names one; a private folder is created only where it is unset.
    """
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staged tables."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store); "
                               "lineage cuts must survive the loss of an executor")
        # Unset in a local session (tests, benches): a private folder will do.
        d = tempfile.mkdtemp(prefix="cadence-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
