"""Column expressions used across the layers (all built-in, JVM side)."""

from tributary.functions.keys import message_key, stable_key
from tributary.functions.text import blank_to_null, clean_text, is_blank, normalise
from tributary.functions.time import (
    arrival_lag_days,
    calendar_parts,
    clock,
    clock_date,
    date_key,
    event_time,
)
from tributary.functions.values import (
    coerce_date,
    coerce_timestamp,
    null_safe_long,
    safe_percent,
)

__all__ = [
    "arrival_lag_days",
    "blank_to_null",
    "calendar_parts",
    "clean_text",
    "clock",
    "clock_date",
    "coerce_date",
    "coerce_timestamp",
    "date_key",
    "event_time",
    "is_blank",
    "message_key",
    "normalise",
    "null_safe_long",
    "safe_percent",
    "stable_key",
]
