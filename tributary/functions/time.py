"""Event-time, calendar and clock expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.util import as_column

# Largest magnitude of Unix seconds a Spark timestamp can hold.
_MAX_UNIX_SECONDS = 9_223_372_036_854

# Years whose days have a ``yyyyMMdd`` key in an int. Times outside count as
# unreadable, so that every accepted time has a key.
FIRST_YEAR, LAST_YEAR = 1, 214_748


def event_time(datetime_text: Column | str, unix_seconds: Column | str) -> Column:
    """ISO text first, Unix seconds as fallback, null when both fail or when
    the time found lies outside ``FIRST_YEAR`` to ``LAST_YEAR``.

    ``try_to_timestamp`` keeps a malformed text from failing the job under
    ANSI mode; ``timestamp_seconds`` converts without a string round trip, so
    the repeated hour at a daylight-saving change is not shifted.
    """
    seconds = as_column(unix_seconds)
    from_seconds = F.when(
        seconds.between(-_MAX_UNIX_SECONDS, _MAX_UNIX_SECONDS),
        F.timestamp_seconds(seconds),
    )
    found = F.coalesce(F.try_to_timestamp(as_column(datetime_text)), from_seconds)
    return F.when(F.year(found).between(FIRST_YEAR, LAST_YEAR), found)


def date_key(date: Column | str) -> Column:
    """``yyyyMMdd`` as int; null outside ``FIRST_YEAR`` to ``LAST_YEAR``."""
    d = as_column(date)
    key = F.year(d) * 10_000 + F.month(d) * 100 + F.dayofmonth(d)
    return F.when(F.year(d).between(FIRST_YEAR, LAST_YEAR), key)


def calendar_parts(date: Column | str) -> dict[str, Column]:
    """Year, quarter, month, day and day of week (1 = Sunday)."""
    d = as_column(date)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
    }


def arrival_lag_days(ingested_date: Column | str, event_date: Column | str) -> Column:
    """Days from event date to ingest date; negative when ingested earlier."""
    return F.datediff(as_column(ingested_date), as_column(event_date))


def clock(as_of: dt.datetime | None = None) -> Column:
    """Current timestamp, or a fixed one for repeatable runs."""
    if as_of is None:
        return F.current_timestamp()
    # Text, not a Python datetime: a naive value is read in the session zone
    # rather than in the driver machine's zone.
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def clock_date(as_of: dt.datetime | dt.date | None = None) -> Column:
    """Current date, or the date of a fixed ``as_of``."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, dt.datetime):
        return F.to_date(clock(as_of))
    return F.lit(as_of.isoformat()).cast("date")
