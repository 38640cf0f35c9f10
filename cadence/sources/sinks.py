"""Writers for the four outputs.

An overwrite publishes a version: the rows are written once, into a folder that
no reader uses, with REQUIRED columns asserted and rows counted in the same
pass (S9); then one step makes it the table. A failure before that step leaves
the old version readable, and there is no moment without one.

* A path holds versions in ``SLOTS`` folders that take turns, and a log to which
  the number of each published version is appended; ``read_back`` reads the newest.
  A path that holds plain files is read as it is until it is first overwritten.
* A catalog table's versions stand beside it in its database's folder; the step is
  ``ALTER TABLE .. SET LOCATION`` (or the table's creation).

An empty frame is not published, leaving the previous table in place (S8). An
append adds files to the current version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.conform import null_key_violations

SLOTS = 3


@dataclass
class WriteResult:
    target: str
    mode: str
    rows_written: int
    skipped: bool
    table_rows: int | None = None  # rows in the table after the write


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the target database if it does not exist."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _guard_required(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        return df
    bad = null_key_violations(df, schema)
    if bad is None:
        return df
    first = df.columns[0]
    check = F.when(bad, F.raise_error(F.lit("null value in a REQUIRED column"))).otherwise(F.col(first))
    return df.withColumn(first, check)


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet",
                schema: T.StructType | None = None, skip_empty: bool = True,
                partition_by: list[str] | None = None, probe: DataFrame | None = None) -> WriteResult:
    """Write ``df`` to ``target`` (path or table) and report rows.

    ``probe``, when given, is a cheaper frame that is empty exactly when
    ``df`` is (e.g. the grid's user ranges); the S8 check reads it instead.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    if skip_empty and probe is not None and probe.isEmpty():
        return WriteResult(target, mode, 0, True)
    spark = df.sparkSession
    obs = Observation("write")
    out = _guard_required(df, schema).observe(obs, F.count(F.lit(1)).alias("rows"))
    version, place = _current(spark, target)
    if mode == "append" and place is not None:
        if skip_empty and probe is None and df.isEmpty():
            return WriteResult(target, mode, 0, True)
        files = "append"
    else:
        version, place, files = version + 1, _slot(spark, target, version + 1), "overwrite"
    w = out.write.mode(files).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(place)
    rows = int(obs.get["rows"])
    if skip_empty and not rows:
        return WriteResult(target, mode, 0, True)
    _publish(spark, target, version, place, fmt, bool(partition_by))
    # After an overwrite the table holds exactly what was written; after an
    # append it is counted (parquet footers only, no data pages).
    table_rows = rows if mode == "overwrite" else read_back(spark, target, fmt).count()
    return WriteResult(target, mode, rows, False, table_rows)


def _log(target: str) -> str:
    return f"{target.rstrip('/')}/_published"


def _slot(spark: SparkSession, target: str, version: int) -> str:
    if _is_path(target):
        return f"{target.rstrip('/')}/_slot{version % SLOTS}"
    *db, name = target.replace("`", "").split(".")
    base = spark.catalog.getDatabase(db[-1] if db else spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{name}__slot{version % SLOTS}"


def _current(spark: SparkSession, target: str) -> tuple[int, str | None]:
    """Number and place of the published version; -1 and None, or the place of plain files, if there is none."""
    if not _is_path(target):
        if not spark.catalog.tableExists(target):
            return -1, None
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").where("col_name = 'Location'").first()["data_type"]
        slot = place.rstrip("/").rpartition("__slot")
        return (int(slot[2]) if slot[1] and slot[2].isdigit() else -1), place
    try:
        newest = spark.read.schema("version long").parquet(_log(target)).agg(F.max("version")).first()[0]
        if newest is not None:
            return newest, _slot(spark, target, newest)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    try:
        plain = spark.read.format("binaryFile").load(target).select("path").limit(1).count()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        plain = 0
    return -1, target if plain else None


def _publish(spark: SparkSession, target: str, version: int, place: str, fmt: str, partitioned: bool) -> None:
    """The one step that makes ``place`` the table."""
    if _is_path(target):
        if version >= 0 and _current(spark, target)[0] != version:
            spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(_log(target))
        return
    if not spark.catalog.tableExists(target):
        spark.catalog.createTable(target, path=place, source=fmt)
    else:
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{place}'")
        spark.catalog.refreshTable(target)
    if partitioned:
        spark.catalog.recoverPartitions(target)


def exists(spark: SparkSession, target: str) -> bool:
    """Whether a target (path or table) is there."""
    return _current(spark, target)[1] is not None


def read_back(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """The published version of a path or table."""
    if not _is_path(target):
        return spark.read.table(target)
    return spark.read.format(fmt).load(_current(spark, target)[1] or target)
