"""Behaviour predicates on event and screen names.

Each predicate is null-safe (a null name is simply "no match"), so the
per-session ``bool_or`` over them is never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical flags.
CLICKED_INVITE_EVENT = "click_invite_to_event"
VIEWED_EVENT = "view_event"
JOINED_EVENT = "join_event"
STARTED_QUIZ_EVENT = "start_quiz"
COMPLETED_QUIZ_EVENT = "finish_quiz"
INVITED_SOMEONE_EVENTS = ["invite_friends", "send_invite_to_event", "invite_friends_for_report"]
ENABLED_CONTACTS_WORDS = ["contact", "enable"]
DISCOVER_SCREEN = "Discover"


def _safe(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def event_flags(name_col: str) -> dict[str, Column]:
    """Per-event predicates for the event-name flags."""
    e = F.col(name_col)
    low = F.lower(e)
    contacts = low.contains(ENABLED_CONTACTS_WORDS[0]) & low.contains(ENABLED_CONTACTS_WORDS[1])
    return {
        "viewed_event": _safe(e == VIEWED_EVENT),
        "joined_event": _safe(e == JOINED_EVENT),
        "invited_someone": _safe(e.isin(INVITED_SOMEONE_EVENTS)),
        "enabled_contacts": _safe(contacts),
        "clicked_invite": _safe(e == CLICKED_INVITE_EVENT),
        "started_quiz": _safe(e == STARTED_QUIZ_EVENT),
        "completed_quiz": _safe(e == COMPLETED_QUIZ_EVENT),
    }


def visited_discover(screen_col: str) -> Column:
    return _safe(F.col(screen_col) == DISCOVER_SCREEN)
