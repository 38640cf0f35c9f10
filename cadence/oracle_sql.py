"""DuckDB twins of the registered queries (the correctness oracle).

Written in the direct form: ``row_number()`` dedups, a correlated ``EXISTS``
for the in-session flag, ``lag`` for gaps, ``quantile_disc`` for the median's
middle values, churn read from the
dense grid, and unions for the phone / id fallback. The Spark side uses
scale-oriented forms (keep-first aggregates, running counts, a single
resolution join, sparse churn), so each comparison also checks that those
rewrites are exact. Inputs come from the same adapter expressions as the
Spark side (``cadence.sources.adapters.duckdb_input_ctes``).
"""

from __future__ import annotations

from cadence import schemas
from cadence.functions import flags as fl
from cadence.plans.catalog import ORACLE_PARAMS as P
from cadence.plans.catalog import FLOAT_DIGITS, ROUNDED_FOR_COMPARISON, TRIAL_ROWS
from cadence.schemas import PEOPLE_AGGREGATED
from cadence.sources.adapters import duckdb_input_ctes

END = f"DATE '{P.end_date.isoformat()}'"
THR = int(P.threshold_days)
RUN_TS = f"TIMESTAMP '{P.run_ts.isoformat(sep=' ')}'"
SINCE = f"TIMESTAMP '{P.since.isoformat(sep=' ')}'"
LIB = P.mobile_lib

_USER_COLS = "user_id, fullName, phoneNumber, username, email, contactAccessGranted, businessUser, createdAt"
_U_COLS = ", ".join(f"u.{c.strip()}" for c in _USER_COLS.split(","))
_META = "start_timestamp, end_timestamp, autocapture_count, screen_count, session_duration"
_FLAGS = ("viewed_event, joined_event, invited_someone, enabled_contacts, clicked_invite, scrolled, "
          "visited_discover, started_quiz, completed_quiz")
_SESSIONS_OUT = (
    "session_id, distinct_id, city, country, created_event, viewed_event, joined_event, "
    "invited_someone, enabled_contacts, clicked_invite, scrolled, visited_discover, "
    "scroll_event_count, started_quiz, completed_quiz, start_timestamp, end_timestamp, "
    "autocapture_count, screen_count, session_duration, user_id, fullName, phoneNumber, "
    "username, email, contactAccessGranted, businessUser, createdAt, etl_loaded_at")


def _prop(key: str) -> str:
    return f"CASE WHEN json_valid(properties) THEN json_extract_string(properties, '$.\"{key}\"') END"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _flag(pred: str) -> str:
    return f"bool_or(coalesce({pred}, false))"


def _first(col: str) -> str:
    order = ("match_rank, session_id, start_timestamp NULLS LAST, fullName NULLS LAST, "
             "phoneNumber NULLS LAST, username NULLS LAST, email NULLS LAST")
    return f"first({col} ORDER BY {order}) FILTER (WHERE {col} IS NOT NULL) AS {col}"


_PEOPLE_FLAGS = ["created_event", "viewed_event", "joined_event", "invited_someone", "enabled_contacts",
                 "scrolled", "visited_discover", "started_quiz", "completed_quiz"]
_PEOPLE_PROFILE = ["fullName", "phoneNumber", "username", "email", "contactAccessGranted",
                   "businessUser", "createdAt", "city", "country"]
_COUNTS = [("scroll_event_count", "total_scrolls", "avg_scrolls_per_session", "max_scrolls_per_session"),
           ("autocapture_count", "total_autocaptures", "avg_autocaptures_per_session",
            "max_autocaptures_per_session"),
           ("screen_count", "total_screens", "avg_screens_per_session", "max_screens_per_session")]


_PEOPLE_ALL = PEOPLE_AGGREGATED.fieldNames()


def _round_doubles(cols) -> str:
    return ", ".join(f"round({c}, {FLOAT_DIGITS}) AS {c}" if c in ROUNDED_FOR_COMPARISON else c
                     for c in cols)


def _kind_churn(a: str, kind: str) -> str:
    return f"""
    CASE WHEN {a}.user_id IS NULL THEN 'never_active'
         WHEN {END} - {a}.last_d > {THR} THEN 'churned'
         WHEN {a}.times > 0 THEN 'reactivated' ELSE 'active' END AS {kind}_churn_state,
    CASE WHEN {END} - {a}.last_d > {THR} THEN {a}.last_d + {THR} END AS {kind}_churn_date,
    CAST(coalesce({a}.times, 0) AS BIGINT) AS {kind}_times_churned,
    CAST({END} - {a}.last_d AS BIGINT) AS days_since_last_{kind}_activity,
    {a}.first_d AS first_{kind}_active_date,
    {a}.last_d AS last_{kind}_active_date"""


def _churn_ctes(src: str, prefix: str) -> str:
    return f"""
{prefix}flags AS (
  SELECT user_id, date, event_count, events_created_count, accepted,
    coalesce(event_count, 0) > 0 AS app,
    coalesce(events_created_count, 0) + coalesce(accepted, 0) + coalesce(invited, 0)
      + coalesce(rejected, 0) > 0 AS biz
  FROM {src}),
{prefix}app_days AS (
  SELECT user_id, date, date - lag(date) OVER (PARTITION BY user_id ORDER BY date) AS gap
  FROM {prefix}flags WHERE app),
{prefix}biz_days AS (
  SELECT user_id, date, date - lag(date) OVER (PARTITION BY user_id ORDER BY date) AS gap
  FROM {prefix}flags WHERE biz),
{prefix}app_u AS (
  SELECT user_id, min(date) AS first_d, max(date) AS last_d,
    count(*) FILTER (WHERE gap > {THR}) AS times
  FROM {prefix}app_days GROUP BY user_id),
{prefix}biz_u AS (
  SELECT user_id, min(date) AS first_d, max(date) AS last_d,
    count(*) FILTER (WHERE gap > {THR}) AS times
  FROM {prefix}biz_days GROUP BY user_id),
{prefix}totals AS (
  SELECT user_id, CAST(coalesce(sum(events_created_count), 0) AS BIGINT) AS total_events_created,
    CAST(coalesce(sum(accepted), 0) AS BIGINT) AS total_events_attended,
    CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total_app_interactions
  FROM {prefix}flags GROUP BY user_id),
{prefix}churn AS (
  SELECT coalesce(a.user_id, b.user_id) AS user_id, {_kind_churn("a", "app")}, {_kind_churn("b", "biz")},
    t.total_events_created, t.total_events_attended, t.total_app_interactions,
    {RUN_TS} AS etl_loaded_at
  FROM {prefix}app_u a FULL OUTER JOIN {prefix}biz_u b ON a.user_id = b.user_id
  LEFT JOIN {prefix}totals t ON t.user_id = coalesce(a.user_id, b.user_id))"""


def _ctes(derive_inputs: bool = True) -> str:
    """The oracle's CTEs. With ``derive_inputs`` the six inputs are derived
    from the driver tables; without, they must exist as tables/views."""
    parsed_cols = ",\n    ".join(
        f"{_prop(k)} AS {n}" for k, n in [("$session_id", "session_id"), ("$lib", "lib"),
                                          ("$screen_name", "screen_name"), ("$geoip_city_name", "city"),
                                          ("$geoip_country_name", "country"), ("$touch_x", "touch_x"),
                                          ("$touch_y", "touch_y")])
    people_cols = [
        "CAST(count(session_id) AS BIGINT) AS total_sessions",
        "CAST(sum(CAST(session_duration AS DECIMAL(18,6))) AS DOUBLE) / count(session_duration)"
        " AS avg_session_duration",
        "(quantile_disc(session_duration, 0.5) - quantile_disc(-session_duration, 0.5)) / 2"
        " AS median_session_duration",
        "coalesce(CAST(sum(CAST(session_duration AS DECIMAL(18,6))) AS DOUBLE), 0.0)"
        " AS total_session_duration",
        "min(session_duration) AS min_session_duration",
        "max(session_duration) AS max_session_duration",
        "stddev_samp(session_duration) AS std_session_duration",
        *[f"CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS {c}_sum" for c in _PEOPLE_FLAGS],
    ]
    for src, tot, avg, mx in _COUNTS:
        people_cols += [f"CAST(coalesce(sum({src}), 0) AS BIGINT) AS {tot}", f"avg({src}) AS {avg}",
                        f"CAST(max({src}) AS BIGINT) AS {mx}"]
    people_cols += ["min(start_timestamp) AS first_session_date", "max(start_timestamp) AS last_session_date",
                    *[_first(c) for c in _PEOPLE_PROFILE]]
    days = "(epoch_us(last_session_date) - epoch_us(first_session_date)) / 86400e6"
    inputs = f"{duckdb_input_ctes()}," if derive_inputs else ""
    return f"""
{inputs}
parsed AS (
  SELECT event AS event_name, distinct_id, timestamp,
    {parsed_cols}
  FROM product_events),
extracted AS (
  SELECT * FROM parsed
  WHERE lib = '{LIB}' AND session_id IS NOT NULL
    AND (distinct_id IS NULL OR distinct_id NOT IN (SELECT id FROM excluded))),
behaviour AS (
  SELECT session_id,
    arg_min(distinct_id, timestamp) FILTER (WHERE distinct_id IS NOT NULL) AS distinct_id,
    arg_min(city, timestamp) FILTER (WHERE city IS NOT NULL) AS city,
    arg_min(country, timestamp) FILTER (WHERE country IS NOT NULL) AS country,
    {_flag(f"event_name = '{fl.VIEWED_EVENT}'")} AS viewed_event,
    {_flag(f"event_name = '{fl.JOINED_EVENT}'")} AS joined_event,
    {_flag(f"event_name IN ({_in_list(fl.INVITED_SOMEONE_EVENTS)})")} AS invited_someone,
    {_flag(" AND ".join(f"contains(lower(event_name), '{w}')" for w in fl.ENABLED_CONTACTS_WORDS))} AS enabled_contacts,
    {_flag(f"event_name = '{fl.CLICKED_INVITE_EVENT}'")} AS clicked_invite,
    count(touch_x) + count(touch_y) > 0 AS scrolled,
    {_flag(f"screen_name = '{fl.DISCOVER_SCREEN}'")} AS visited_discover,
    CAST(count(touch_x) + count(touch_y) AS BIGINT) AS scroll_event_count,
    {_flag(f"event_name = '{fl.STARTED_QUIZ_EVENT}'")} AS started_quiz,
    {_flag(f"event_name = '{fl.COMPLETED_QUIZ_EVENT}'")} AS completed_quiz
  FROM extracted GROUP BY session_id),
meta AS (
  SELECT * FROM sessions
  WHERE distinct_id IS NULL OR distinct_id NOT IN (SELECT id FROM excluded)),
with_meta AS (
  SELECT b.*, m.start_timestamp, m.end_timestamp, m.autocapture_count, m.screen_count, m.session_duration
  FROM behaviour b LEFT JOIN meta m ON b.session_id = m.session_id AND b.distinct_id = m.distinct_id),
users_w1 AS (
  SELECT {_USER_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY fullName, phoneNumber
      ORDER BY username ASC NULLS LAST, email ASC NULLS LAST, user_id) AS rn
    FROM users) WHERE rn = 1),
matched AS (
  SELECT w.*, {_U_COLS}, 0 AS match_rank
  FROM with_meta w JOIN users_w1 u ON w.distinct_id = u.phoneNumber
  UNION ALL
  SELECT w.*, {_U_COLS}, 1 AS match_rank
  FROM with_meta w JOIN users_w1 u ON w.distinct_id = u.user_id
  WHERE NOT EXISTS (SELECT 1 FROM users_w1 p WHERE p.phoneNumber = w.distinct_id)),
sessions_agg AS (
  SELECT session_id, distinct_id, city, country,
    EXISTS (SELECT 1 FROM app_events a WHERE a.user_id = k.user_id
            AND a.createdAt >= k.start_timestamp AND a.createdAt <= k.end_timestamp) AS created_event,
    {_FLAGS}, scroll_event_count, {_META},
    user_id, fullName, phoneNumber, username, email,
    coalesce(contactAccessGranted, false) AS contactAccessGranted,
    coalesce(businessUser, false) AS businessUser, createdAt,
    {RUN_TS} AS etl_loaded_at, match_rank
  FROM matched k
  WHERE NOT (coalesce(session_duration = 0, false) AND coalesce(autocapture_count = 0, false))),
people_base AS (
  SELECT user_id, {", ".join(people_cols)}
  FROM sessions_agg GROUP BY user_id),
people_full AS (
  SELECT *, {days} AS days_since_first_session,
    total_sessions / ({days} + 1) AS sessions_per_day,
    CAST(created_event_sum + viewed_event_sum + joined_event_sum + scrolled_sum AS DOUBLE)
      / total_sessions AS engagement_score,
    {RUN_TS} AS etl_loaded_at
  FROM people_base),
people AS (
  SELECT {_round_doubles(_PEOPLE_ALL)} FROM people_full),
users_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY phoneNumber
    ORDER BY email IS NULL, username IS NULL, createdAt IS NULL, user_id, fullName) AS rn
  FROM users WHERE phoneNumber IS NOT NULL),
users_nophone AS (
  SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY email IS NULL, username IS NULL, createdAt IS NULL, fullName) AS rn
  FROM users WHERE phoneNumber IS NULL),
lookup AS (
  SELECT user_id, phoneNumber, fullName, username, email, createdAt FROM users_ranked WHERE rn = 1
  UNION ALL
  SELECT user_id, phoneNumber, fullName, username, email, createdAt FROM users_nophone WHERE rn = 1),
profile AS (
  SELECT user_id, phoneNumber, fullName, username, email, createdAt FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY email IS NULL, username IS NULL, createdAt IS NULL, phoneNumber IS NULL, phoneNumber) AS rn
    FROM lookup) WHERE rn = 1),
canon AS (
  SELECT user_id, canonical_id FROM (
    SELECT user_id, canonical_id,
      row_number() OVER (PARTITION BY user_id ORDER BY rk, canonical_id) AS rn
    FROM (SELECT user_id, user_id AS canonical_id, 1 AS rk FROM lookup
          UNION ALL
          SELECT u.user_id, l.user_id AS canonical_id, 2 AS rk
          FROM users u JOIN lookup l ON u.phoneNumber = l.phoneNumber)) WHERE rn = 1),
excluded_ids AS (
  SELECT DISTINCT user_id FROM lookup WHERE phoneNumber IN (SELECT id FROM excluded)),
prod_daily AS (
  SELECT distinct_id, CAST(timestamp AS DATE) AS date, CAST(count(*) AS BIGINT) AS event_count
  FROM product_events WHERE distinct_id IS NOT NULL AND timestamp IS NOT NULL
  GROUP BY distinct_id, CAST(timestamp AS DATE)),
prod_mapped AS (
  SELECT coalesce(pm.user_id, ui.user_id) AS user_id, d.date, d.event_count
  FROM prod_daily d
  LEFT JOIN (SELECT phoneNumber, user_id FROM lookup WHERE phoneNumber IS NOT NULL) pm
    ON d.distinct_id = pm.phoneNumber
  LEFT JOIN (SELECT DISTINCT user_id FROM users) ui
    ON pm.user_id IS NULL AND d.distinct_id = ui.user_id
  WHERE coalesce(pm.user_id, ui.user_id) IS NOT NULL),
created_daily AS (
  SELECT user_id, CAST(createdAt AS DATE) AS date, CAST(count(*) AS BIGINT) AS events_created_count
  FROM app_events WHERE user_id IS NOT NULL AND createdAt IS NOT NULL
  GROUP BY user_id, CAST(createdAt AS DATE)),
invites_daily AS (
  SELECT user_id, CAST(createdAt AS DATE) AS date,
    CAST(count(*) FILTER (WHERE status = 'accepted') AS BIGINT) AS accepted,
    CAST(count(*) FILTER (WHERE status = 'invited') AS BIGINT) AS invited,
    CAST(count(*) FILTER (WHERE status = 'rejected') AS BIGINT) AS rejected
  FROM invites WHERE user_id IS NOT NULL AND createdAt IS NOT NULL AND status IS NOT NULL
  GROUP BY user_id, CAST(createdAt AS DATE)),
created_invites AS (
  SELECT user_id, date, CAST(sum(events_created_count) AS BIGINT) AS events_created_count,
    CAST(sum(accepted) AS BIGINT) AS accepted, CAST(sum(invited) AS BIGINT) AS invited,
    CAST(sum(rejected) AS BIGINT) AS rejected
  FROM (SELECT user_id, date, events_created_count, 0 AS accepted, 0 AS invited, 0 AS rejected
        FROM created_daily
        UNION ALL
        SELECT user_id, date, 0, accepted, invited, rejected FROM invites_daily)
  GROUP BY user_id, date),
combined AS (
  SELECT user_id, date, event_count, 0 AS events_created_count, 0 AS accepted, 0 AS invited,
    0 AS rejected FROM prod_mapped
  UNION ALL SELECT user_id, date, 0, events_created_count, 0, 0, 0 FROM created_daily
  UNION ALL SELECT user_id, date, 0, 0, accepted, invited, rejected FROM invites_daily),
spine AS (
  SELECT coalesce(c.canonical_id, x.user_id) AS user_id, x.date,
    CAST(sum(x.event_count) AS BIGINT) AS event_count,
    CAST(sum(x.events_created_count) AS BIGINT) AS events_created_count,
    CAST(sum(x.accepted) AS BIGINT) AS accepted, CAST(sum(x.invited) AS BIGINT) AS invited,
    CAST(sum(x.rejected) AS BIGINT) AS rejected
  FROM combined x LEFT JOIN canon c ON x.user_id = c.user_id
  WHERE coalesce(c.canonical_id, x.user_id) NOT IN (SELECT user_id FROM excluded_ids)
  GROUP BY coalesce(c.canonical_id, x.user_id), x.date),
ranges AS (
  SELECT f.user_id, coalesce(CAST(p.createdAt AS DATE), f.first_date) AS start_date,
    p.createdAt, p.phoneNumber, p.fullName, p.username, p.email
  FROM (SELECT user_id, min(date) AS first_date FROM spine GROUP BY user_id) f
  LEFT JOIN profile p ON f.user_id = p.user_id
  WHERE coalesce(CAST(p.createdAt AS DATE), f.first_date) <= {END}),
grid AS (
  SELECT user_id, CAST(d AS DATE) AS date, createdAt, phoneNumber, fullName, username, email
  FROM (SELECT *, unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST({END} AS TIMESTAMP),
                                         INTERVAL 1 DAY)) AS d
        FROM ranges)),
daily AS (
  SELECT g.user_id, g.date,
    coalesce(s.event_count, 0) AS event_count,
    coalesce(s.events_created_count, 0) AS events_created_count,
    coalesce(s.accepted, 0) AS accepted, coalesce(s.invited, 0) AS invited,
    coalesce(s.rejected, 0) AS rejected,
    g.createdAt, g.phoneNumber, g.fullName, g.username, g.email, {RUN_TS} AS etl_loaded_at
  FROM grid g LEFT JOIN spine s ON g.user_id = s.user_id AND g.date = s.date),
{_churn_ctes("daily", "")},
gaps AS (
  SELECT user_id, date, app, biz,
    CASE WHEN app THEN CAST(coalesce(date - lag(date) OVER (PARTITION BY user_id, app ORDER BY date), 0) AS BIGINT) END AS app_gap,
    CASE WHEN biz THEN CAST(coalesce(date - lag(date) OVER (PARTITION BY user_id, biz ORDER BY date), 0) AS BIGINT) END AS biz_gap
  FROM flags)
"""


def _people_select(cols: list[str]) -> str:
    return f"SELECT user_id, {', '.join(cols)} FROM people"


_CONFORM = (
    "SELECT session_id, distinct_id, city, country, false AS created_event, viewed_event, joined_event, "
    "invited_someone, enabled_contacts, clicked_invite, scrolled, visited_discover, scroll_event_count, "
    "started_quiz, completed_quiz, CAST(NULL AS TIMESTAMP) AS start_timestamp, "
    "CAST(NULL AS TIMESTAMP) AS end_timestamp, CAST(NULL AS BIGINT) AS autocapture_count, "
    "CAST(NULL AS BIGINT) AS screen_count, CAST(NULL AS DOUBLE) AS session_duration, "
    "CAST(NULL AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS fullName, "
    "CAST(NULL AS VARCHAR) AS phoneNumber, CAST(NULL AS VARCHAR) AS username, "
    f"CAST(NULL AS VARCHAR) AS email, false AS contactAccessGranted, false AS businessUser, "
    f"CAST(NULL AS TIMESTAMP) AS createdAt, {RUN_TS} AS etl_loaded_at FROM behaviour")

_APP_CHURN = ("app_churn_state, app_churn_date, app_times_churned, days_since_last_app_activity, "
              "first_app_active_date, last_app_active_date")
_BIZ_CHURN = _APP_CHURN.replace("app", "biz")

_BODIES = {
    "events_since": f"SELECT * FROM product_events WHERE timestamp >= {SINCE}",
    "events_limited_ordered": ("SELECT * FROM product_events ORDER BY timestamp NULLS FIRST, "
                               "distinct_id NULLS FIRST, event NULLS FIRST, properties NULLS FIRST "
                               f"LIMIT {TRIAL_ROWS}"),
    "json_events_extracted": "SELECT * FROM parsed",
    "mobile_events_filtered": "SELECT * FROM extracted",
    "users_dedup_name_phone": "SELECT * FROM users_w1",
    "users_dedup_complete": "SELECT * FROM lookup",
    "user_profile": "SELECT * FROM profile",
    "canonical_map": "SELECT * FROM canon",
    "excluded_user_ids": "SELECT * FROM excluded_ids",
    "session_flags": f"SELECT session_id, {_FLAGS} FROM behaviour",
    "session_scrolls": "SELECT session_id, scrolled, scroll_event_count FROM behaviour",
    "session_first_geo": "SELECT session_id, distinct_id, city, country FROM behaviour",
    "session_metadata_join": f"SELECT session_id, distinct_id, {_META} FROM with_meta",
    "session_user_match": f"SELECT session_id, distinct_id, match_rank, {_USER_COLS} FROM matched",
    "session_created_event": (
        "SELECT DISTINCT user_id, start_timestamp, end_timestamp, "
        "EXISTS (SELECT 1 FROM app_events a WHERE a.user_id = m.user_id "
        "AND a.createdAt >= m.start_timestamp AND a.createdAt <= m.end_timestamp) AS created_event "
        "FROM matched m WHERE start_timestamp IS NOT NULL AND end_timestamp IS NOT NULL"),
    "sessions_aggregated": f"SELECT {_SESSIONS_OUT} FROM sessions_agg",
    "conform_missing_columns": _CONFORM,
    "people_durations": _people_select(
        ["total_sessions", "avg_session_duration", "median_session_duration", "total_session_duration",
         "min_session_duration", "max_session_duration", "std_session_duration"]),
    "people_flags": _people_select([f"{c}_sum" for c in _PEOPLE_FLAGS]),
    "people_counts": _people_select([c for t in _COUNTS for c in t[1:]]
                                    + ["first_session_date", "last_session_date"]),
    "people_profile": _people_select(_PEOPLE_PROFILE),
    "people_aggregated": "SELECT * FROM people",
    "daily_product_counts": "SELECT * FROM prod_daily",
    "daily_created_invites": "SELECT * FROM created_invites",
    "activity_spine": "SELECT * FROM spine",
    "user_date_grid": "SELECT user_id, date FROM grid",
    "user_daily_activity": "SELECT * FROM daily",
    "activity_gaps": "SELECT * FROM gaps WHERE app OR biz",
    "app_churn": f"SELECT user_id, {_APP_CHURN} FROM churn",
    "biz_churn": f"SELECT user_id, {_BIZ_CHURN} FROM churn",
    "activity_totals": ("SELECT user_id, total_events_created, total_events_attended, "
                        "total_app_interactions FROM churn"),
    "user_churn_state": "SELECT * FROM churn",
    "user_churn_state_from_grid": "SELECT * FROM churn",
    "load_overwrite_append": "SELECT * FROM churn UNION ALL SELECT * FROM churn",
    "load_empty_skipped": "SELECT * FROM churn",
    "load_new_database": "SELECT * FROM churn",
    **{f"source_{name}": f"SELECT {', '.join(schemas.INPUTS[name].fieldNames())} FROM {name}"
       for name in ("sessions", "users", "app_events", "invites")},
    "incremental_sessions": f"SELECT {_SESSIONS_OUT} FROM sessions_agg",
    "incremental_people": "SELECT * FROM people",
    "incremental_all_inputs_sessions": f"SELECT {_SESSIONS_OUT} FROM sessions_agg",
    "incremental_all_inputs_people": "SELECT * FROM people",
    "incremental_spine": "SELECT * FROM spine",
    "since_over_stored_sessions": f"SELECT {_SESSIONS_OUT} FROM sessions_agg",
    "since_over_stored_spine": "SELECT * FROM spine",
}


def oracle_sql() -> dict[str, str]:
    ctes = _ctes()
    return {name: f"WITH {ctes}\n{body}" for name, body in _BODIES.items()}


def oracle_over_inputs(name: str) -> str:
    """The twin of query ``name`` over input tables named like the engine's
    inputs (users, product_events, sessions, app_events, invites, excluded)."""
    return f"WITH {_ctes(derive_inputs=False)}\n{_BODIES[name]}"
