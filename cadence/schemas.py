"""Input and output schemas.

Output column order and types are fixed (the four target tables). Warehouse
INTEGER maps to LongType, FLOAT to DoubleType; ``nullable=False`` marks the
REQUIRED keys, which :func:`cadence.functions.conform.conform` checks.
"""

from pyspark.sql import types as T

S, L, D, B, TS, DT = (T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(),
                      T.TimestampType(), T.DateType())


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def _f(name, typ, nullable=True):
    return (name, typ, nullable)


# ---------------------------------------------------------------- inputs

PRODUCT_EVENTS = _schema(_f("event", S), _f("distinct_id", S), _f("timestamp", TS),
                         _f("properties", S))

SESSIONS = _schema(_f("session_id", S, False), _f("distinct_id", S),
                   _f("start_timestamp", TS), _f("end_timestamp", TS),
                   _f("session_duration", D), _f("autocapture_count", L),
                   _f("screen_count", L))

USERS = _schema(_f("user_id", S, False), _f("fullName", S), _f("phoneNumber", S),
                _f("username", S), _f("email", S), _f("contactAccessGranted", B),
                _f("businessUser", B), _f("createdAt", TS))

APP_EVENTS = _schema(_f("user_id", S), _f("createdAt", TS))

INVITES = _schema(_f("user_id", S), _f("createdAt", TS), _f("status", S))

EXCLUDED = _schema(_f("id", S, False))

INPUTS = {
    "product_events": PRODUCT_EVENTS,
    "sessions": SESSIONS,
    "users": USERS,
    "app_events": APP_EVENTS,
    "invites": INVITES,
    "excluded": EXCLUDED,
}

# Fixed values that must equal the reference's: the JSON keys read from
# product_events.properties (all kept as strings), the output table and
# column names in their order, and the invite statuses pivoted to columns.
PROPERTY_KEYS = ["$session_id", "$lib", "$screen_name", "$geoip_city_name",
                 "$geoip_country_name", "$touch_x", "$touch_y"]
PROPERTIES = T.StructType([T.StructField(k, S) for k in PROPERTY_KEYS])

# ---------------------------------------------------------------- outputs

SESSION_FLAGS = ["created_event", "viewed_event", "joined_event", "invited_someone",
                 "enabled_contacts", "clicked_invite", "scrolled", "visited_discover"]

SESSIONS_AGGREGATED = _schema(
    _f("session_id", S, False), _f("distinct_id", S), _f("city", S), _f("country", S),
    _f("created_event", B), _f("viewed_event", B), _f("joined_event", B),
    _f("invited_someone", B), _f("enabled_contacts", B), _f("clicked_invite", B),
    _f("scrolled", B), _f("visited_discover", B),
    _f("scroll_event_count", L), _f("started_quiz", B), _f("completed_quiz", B),
    _f("start_timestamp", TS), _f("end_timestamp", TS),
    _f("autocapture_count", L), _f("screen_count", L), _f("session_duration", D),
    _f("user_id", S), _f("fullName", S), _f("phoneNumber", S), _f("username", S),
    _f("email", S), _f("contactAccessGranted", B), _f("businessUser", B),
    _f("createdAt", TS), _f("etl_loaded_at", TS),
)

PEOPLE_FLAG_SUMS = ["created_event", "viewed_event", "joined_event", "invited_someone",
                    "enabled_contacts", "scrolled", "visited_discover", "started_quiz",
                    "completed_quiz"]

PEOPLE_AGGREGATED = _schema(
    _f("user_id", S, False), _f("total_sessions", L),
    _f("avg_session_duration", D), _f("median_session_duration", D),
    _f("total_session_duration", D), _f("min_session_duration", D),
    _f("max_session_duration", D), _f("std_session_duration", D),
    _f("created_event_sum", L), _f("viewed_event_sum", L), _f("joined_event_sum", L),
    _f("invited_someone_sum", L), _f("enabled_contacts_sum", L), _f("scrolled_sum", L),
    _f("visited_discover_sum", L), _f("started_quiz_sum", L), _f("completed_quiz_sum", L),
    _f("total_scrolls", L), _f("avg_scrolls_per_session", D), _f("max_scrolls_per_session", L),
    _f("total_autocaptures", L), _f("avg_autocaptures_per_session", D),
    _f("max_autocaptures_per_session", L),
    _f("total_screens", L), _f("avg_screens_per_session", D), _f("max_screens_per_session", L),
    _f("first_session_date", TS), _f("last_session_date", TS),
    _f("fullName", S), _f("phoneNumber", S), _f("username", S), _f("email", S),
    _f("contactAccessGranted", B), _f("businessUser", B), _f("createdAt", TS),
    _f("city", S), _f("country", S),
    _f("days_since_first_session", D), _f("sessions_per_day", D), _f("engagement_score", D),
    _f("etl_loaded_at", TS),
)

ACTIVITY_COUNTS = ["event_count", "events_created_count", "accepted", "invited", "rejected"]
INVITE_STATUSES = ["accepted", "invited", "rejected"]

USER_DAILY_ACTIVITY = _schema(
    _f("user_id", S, False), _f("date", DT, False),
    _f("event_count", L), _f("events_created_count", L),
    _f("accepted", L), _f("invited", L), _f("rejected", L),
    _f("createdAt", TS), _f("phoneNumber", S), _f("fullName", S), _f("username", S),
    _f("email", S), _f("etl_loaded_at", TS),
)

USER_CHURN_STATE = _schema(
    _f("user_id", S, False),
    _f("app_churn_state", S), _f("app_churn_date", DT), _f("app_times_churned", L),
    _f("days_since_last_app_activity", L), _f("first_app_active_date", DT),
    _f("last_app_active_date", DT),
    _f("biz_churn_state", S), _f("biz_churn_date", DT), _f("biz_times_churned", L),
    _f("days_since_last_biz_activity", L), _f("first_biz_active_date", DT),
    _f("last_biz_active_date", DT),
    _f("total_events_created", L), _f("total_events_attended", L),
    _f("total_app_interactions", L), _f("etl_loaded_at", TS),
)

OUTPUTS = {
    "sessions_aggregated": SESSIONS_AGGREGATED,
    "people_aggregated": PEOPLE_AGGREGATED,
    "user_daily_activity": USER_DAILY_ACTIVITY,
    "user_churn_state": USER_CHURN_STATE,
}
