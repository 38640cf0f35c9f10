"""Driver tables -> the engine's five inputs.

The test data is a TPC-H-like star schema plus an ``events`` stream. The
engine's inputs are derived from it deterministically, so every input grows
with the given tables:

* ``users``          one per ``customer`` row; phones shared by some pairs,
                     missing for others; some duplicate (name, phone) pairs;
                     profile fields null on a modulus.
* ``product_events`` one per ``events`` row; ``distinct_id`` rotates between
                     phone, user id and unknown ids; ``properties`` is a JSON
                     string (a few malformed) carrying session id, client lib,
                     screen, geo and touch fields.
* ``sessions``       session metadata: one row per (user, 6-hour block) over
                     all events, some withheld.
* ``app_events``     the ``purchase`` events (a few under unknown ids).
* ``invites``        the ``signup``/``click`` events with a status.
* ``excluded``       phones of one customer in fifty.

Each column rule is written once as an SQL expression that Spark SQL and
DuckDB both accept, so the oracle (``cadence.oracle_sql``) starts from the
very same inputs. Only three helpers differ by dialect (JSON field, epoch
seconds, seconds -> timestamp).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.params import MOBILE_LIB
from cadence.session import scratch_path

# Dialect helpers: (spark, duckdb) templates.
_K = {
    "spark": "CAST(get_json_object(props, '$.k') AS INT)",
    "duckdb": "CAST(json_extract_string(props, '$.k') AS INTEGER)",
}
_TS = {"spark": "CAST(ts AS TIMESTAMP)", "duckdb": "ts"}
_BLOCK = {
    "spark": "CAST(floor(unix_seconds(CAST(ts AS TIMESTAMP)) / 21600) AS BIGINT)",
    "duckdb": "CAST(floor(epoch(ts) / 21600) AS BIGINT)",
}
_CREATED = {
    "spark": "timestamp_seconds({secs})",
    "duckdb": "make_timestamp(CAST({secs} AS BIGINT) * 1000000)",
}
_DURATION = {
    "spark": "CAST(unix_micros(max(timestamp)) - unix_micros(min(timestamp)) AS DOUBLE) / 1e6",
    "duckdb": "CAST(epoch_us(max(timestamp)) - epoch_us(min(timestamp)) AS DOUBLE) / 1e6",
}
_FIRST_NON_NULL_ID = {
    "spark": "min_by(distinct_id, CASE WHEN distinct_id IS NOT NULL THEN timestamp END)",
    "duckdb": "arg_min(distinct_id, timestamp) FILTER (WHERE distinct_id IS NOT NULL)",
}

# ------------------------------------------------------------------ users
_PHONE_KEY = ("CASE WHEN c_custkey % 11 = 3 THEN NULL "
              "WHEN c_custkey % 13 = 5 THEN c_custkey - 1 ELSE c_custkey END")
_PHONE = f"'+1555' || lpad(CAST(({_PHONE_KEY}) AS STRING), 7, '0')"
_NAME_KEY = "CASE WHEN c_custkey % 26 = 5 THEN c_custkey - 1 ELSE c_custkey END"
# 2023-12-15 00:00:00 UTC plus (key mod 60) days and (key mod 24) hours.
_CREATED_SECS = "(1702598400 + (c_custkey % 60) * 86400 + (c_custkey % 24) * 3600)"


def users_exprs(dialect: str) -> list[str]:
    created = _CREATED[dialect].format(secs=_CREATED_SECS)
    return [
        "'u' || CAST(c_custkey AS STRING) AS user_id",
        f"CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 'Name ' || CAST(({_NAME_KEY}) AS STRING) END AS fullName",
        f"{_PHONE} AS phoneNumber",
        "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'user' || CAST(c_custkey AS STRING) END AS username",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'c' || CAST(c_custkey AS STRING) || '@example.com' END AS email",
        "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal > 0 END AS contactAccessGranted",
        "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment = 'BUILDING' END AS businessUser",
        f"CASE WHEN c_custkey % 17 = 4 THEN NULL ELSE {created} END AS createdAt",
    ]


def excluded_exprs() -> tuple[str, str]:
    """(select expression, where predicate) over customer."""
    return f"{_PHONE} AS id", f"c_custkey % 50 = 7 AND ({_PHONE_KEY}) IS NOT NULL"


# ---------------------------------------------------------- product events
# Columns of the customer side joined to events: phone, nation name.
_EV_PHONE = "c_phone"
_SESSION_KEY = "'s' || CAST(user_id AS STRING) || '_' || CAST(block AS STRING)"


def _jstr(expr: str) -> str:
    return f"CASE WHEN ({expr}) IS NULL THEN 'null' ELSE '\"' || ({expr}) || '\"' END"


def _jnum(expr: str) -> str:
    return f"CASE WHEN ({expr}) IS NULL THEN 'null' ELSE CAST(({expr}) AS STRING) END"


_EVENT_NAME = (
    "CASE event_type WHEN 'view' THEN 'view_event' WHEN 'signup' THEN 'join_event' "
    "WHEN 'click' THEN (CASE k % 4 WHEN 0 THEN 'click_invite_to_event' WHEN 1 THEN 'invite_friends' "
    "WHEN 2 THEN 'send_invite_to_event' ELSE 'invite_friends_for_report' END) "
    "WHEN 'purchase' THEN (CASE WHEN k % 2 = 0 THEN 'start_quiz' ELSE 'finish_quiz' END) "
    "ELSE (CASE k % 3 WHEN 0 THEN 'Contacts_Enabled' WHEN 1 THEN 'contact_list_opened' "
    "ELSE 'enable_contact_sync' END) END")
_DISTINCT_ID = (
    "CASE WHEN event_id % 23 = 0 THEN NULL "
    "WHEN event_id % 31 = 0 THEN 'ghost' || CAST(user_id AS STRING) "
    f"WHEN user_id % 3 = 0 THEN 'u' || CAST(user_id AS STRING) "
    f"WHEN user_id % 3 = 1 THEN {_EV_PHONE} "
    f"WHEN event_id % 2 = 0 THEN {_EV_PHONE} ELSE 'u' || CAST(user_id AS STRING) END")
_P_SESSION = f"CASE WHEN event_id % 17 = 0 THEN NULL ELSE {_SESSION_KEY} END"
_P_LIB = f"CASE WHEN event_id % 5 = 4 THEN 'web' ELSE '{MOBILE_LIB}' END"
_P_SCREEN = ("CASE k % 5 WHEN 0 THEN 'Discover' WHEN 1 THEN 'Home' WHEN 2 THEN 'Profile' "
             "WHEN 3 THEN 'discover' ELSE NULL END")
_P_CITY = "CASE WHEN k % 4 = 0 THEN NULL ELSE 'City ' || CAST(k % 7 AS STRING) END"
_P_COUNTRY = "CASE WHEN k % 6 = 0 THEN NULL ELSE n_name END"
_P_TOUCH_X = "CASE WHEN k % 3 = 0 THEN k END"
_P_TOUCH_Y = "CASE WHEN k % 5 < 2 THEN k * 2 END"
_PROPERTIES = (
    "CASE WHEN event_id % 97 = 13 THEN 'not json' ELSE "
    f"'{{\"$session_id\": ' || {_jstr(_P_SESSION)} || "
    f"', \"$lib\": ' || {_jstr(_P_LIB)} || "
    f"', \"$screen_name\": ' || {_jstr(_P_SCREEN)} || "
    f"', \"$geoip_city_name\": ' || {_jstr(_P_CITY)} || "
    f"', \"$geoip_country_name\": ' || {_jstr(_P_COUNTRY)} || "
    f"', \"$touch_x\": ' || {_jnum(_P_TOUCH_X)} || "
    f"', \"$touch_y\": ' || {_jnum(_P_TOUCH_Y)} || '}}' END")


def events_base_exprs(dialect: str) -> list[str]:
    """Per-event columns over events joined to customer/nation (aliases
    ``c_phone``, ``n_name``)."""
    return ["event_id", "user_id", "event_type", f"{_TS[dialect]} AS timestamp",
            f"{_K[dialect]} AS k", f"{_BLOCK[dialect]} AS block", _EV_PHONE, "n_name",
            f"({_DISTINCT_ID}) AS distinct_id"]


def product_event_exprs() -> list[str]:
    return [f"({_EVENT_NAME}) AS event", "distinct_id", "timestamp",
            f"({_PROPERTIES}) AS properties"]


def session_agg_exprs(dialect: str) -> list[str]:
    return [
        f"{_SESSION_KEY} AS session_id",
        f"{_FIRST_NON_NULL_ID[dialect]} AS distinct_id",
        "min(timestamp) AS start_timestamp",
        "max(timestamp) AS end_timestamp",
        f"{_DURATION[dialect]} AS session_duration",
        "CASE WHEN min(event_id) % 11 = 0 THEN NULL ELSE "
        "CAST(sum(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END) AS BIGINT) END AS autocapture_count",
        "CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS screen_count",
    ]


def session_keep(first_event: str) -> str:
    """Sessions whose metadata is kept (one in nineteen is withheld)."""
    return f"{first_event} % 19 <> 7"


APP_EVENT_EXPRS = [
    "CASE WHEN k % 10 = 9 THEN 'x' || CAST(user_id AS STRING) ELSE 'u' || CAST(user_id AS STRING) END AS user_id",
    "CASE WHEN k % 25 = 24 THEN NULL ELSE timestamp END AS createdAt",
]
APP_EVENT_WHERE = "event_type = 'purchase'"

INVITE_EXPRS = [
    "'u' || CAST(user_id AS STRING) AS user_id",
    "timestamp AS createdAt",
    "CASE k % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'invited' WHEN 2 THEN 'rejected' "
    "WHEN 3 THEN 'pending' ELSE NULL END AS status",
]
INVITE_WHERE = "event_type IN ('signup', 'click')"


# ------------------------------------------------------------ Spark side

def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _customer_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .selectExpr("c_custkey", f"{_PHONE} AS c_phone", "n_name"))


def _events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    side = _customer_side(spark, sf_dir)
    return (ev.join(side, ev.user_id == side.c_custkey, "left")
            .selectExpr(*events_base_exprs("spark")))


# sf_dir -> {input name: parquet path} once ``materialize`` has stored them.
_MATERIALIZED: dict[str, dict[str, str]] = {}


def materialize(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Store the derived inputs as parquet under ``out_dir`` (as the five
    source tables would be stored in production) and read them from there
    from now on. Returns the paths."""
    paths = {}
    n = spark.sparkContext.defaultParallelism
    for name, df in _derive(spark, sf_dir).items():
        path = f"{out_dir.rstrip('/')}/{name}"
        # Laid out as tables usually are: the event table clustered by time
        # (parquet min/max statistics then let a ``since`` filter skip row
        # groups) in a file per core; the small tables in few files.
        laid_out = (df.repartitionByRange(n, "timestamp") if name == "product_events"
                    else df.repartition(max(1, n // 4)))
        laid_out.write.mode("overwrite").parquet(path)
        paths[name] = path
    _MATERIALIZED[sf_dir] = paths
    return paths


def load_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six engine inputs for ``sf_dir``: read back if materialised,
    otherwise derived lazily from the driver tables."""
    if sf_dir in _MATERIALIZED:
        from cadence.sources.readers import read_inputs
        return read_inputs(spark, _MATERIALIZED[sf_dir])
    return _derive(spark, sf_dir)


def load_staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``load_inputs`` for a query that reads the inputs many times: the events are joined to
    their customers once and sessions aggregated once, both stored in the shared folder."""
    if sf_dir in _MATERIALIZED:
        return load_inputs(spark, sf_dir)

    def stored(name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(spark, f"staged-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    found = _derive(spark, sf_dir, stored("events", _events_base(spark, sf_dir)))
    return {**found, "sessions": stored("sessions", found["sessions"])}


def _derive(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six engine inputs derived from the driver tables at ``sf_dir`` (``base``: its
    ``_events_base``, if stored)."""
    customer = _read(spark, sf_dir, "customer")
    base = _events_base(spark, sf_dir) if base is None else base
    sel, where = excluded_exprs()
    return {
        "users": customer.selectExpr(*users_exprs("spark")),
        "product_events": base.selectExpr(*product_event_exprs()),
        "sessions": _sessions(base),
        "app_events": base.where(APP_EVENT_WHERE).selectExpr(*APP_EVENT_EXPRS),
        "invites": base.where(INVITE_WHERE).selectExpr(*INVITE_EXPRS),
        "excluded": customer.where(where).selectExpr(sel),
    }


def _sessions(base: DataFrame) -> DataFrame:
    aggs = [F.expr(e) for e in session_agg_exprs("spark")]
    return (base.groupBy("user_id", "block")
            .agg(*aggs, F.min("event_id").alias("_first_event"))
            .where(F.expr(session_keep("_first_event")))
            .select("session_id", "distinct_id", "start_timestamp", "end_timestamp",
                    "session_duration", "autocapture_count", "screen_count"))


# ------------------------------------------------------------ DuckDB side

def duckdb_input_ctes() -> str:
    """``WITH`` body defining users, product_events, sessions, app_events,
    invites, excluded over the driver's pre-registered views."""
    sel, where = excluded_exprs()
    base_cols = ", ".join(events_base_exprs("duckdb"))
    sess_cols = ", ".join(session_agg_exprs("duckdb"))
    return f"""
users AS (SELECT {", ".join(users_exprs("duckdb"))} FROM customer),
excluded AS (SELECT {sel} FROM customer WHERE {where}),
ev_base AS (
  SELECT {base_cols}
  FROM events LEFT JOIN (
    SELECT c_custkey, {_PHONE} AS c_phone, n_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  ) cs ON events.user_id = cs.c_custkey),
product_events AS (SELECT {", ".join(product_event_exprs())} FROM ev_base),
sessions AS (
  SELECT {sess_cols} FROM ev_base GROUP BY user_id, block HAVING {session_keep("min(event_id)")}),
app_events AS (SELECT {", ".join(APP_EVENT_EXPRS)} FROM ev_base WHERE {APP_EVENT_WHERE}),
invites AS (SELECT {", ".join(INVITE_EXPRS)} FROM ev_base WHERE {INVITE_WHERE})"""
