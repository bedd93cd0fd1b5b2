"""Serving views over the Gold tables.

The dashboard logic is expressed as DataFrame operators; only one-row or
top-n results (bounded by ``max_top_n`` / ``max_recent_rows``) ever reach a
caller that collects them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.time import clock, clock_date
from tributary.functions.values import null_safe_long, safe_percent
from tributary.schemas import (
    DEFAULT_MAX_RECENT_ROWS,
    DEFAULT_MAX_TOP_N,
    DEFAULT_STALE_AFTER_MINUTES,
    VISIBLE_RECENT_COLUMNS,
)


def filter_by_date_range(
    df: DataFrame, column: str, start: dt.date | None, end: dt.date | None
) -> DataFrame:
    """Inclusive on both ends; a frame without the column passes through.

    On a table partitioned by ``column`` the bounds prune folders.
    """
    if column not in df.columns:
        return df
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def serving_order(
    df: DataFrame,
    order_by: str | None = None,
    limit: int | None = None,
    tie_columns: Sequence[str] | None = None,
) -> DataFrame:
    """L4: optional descending sort, optional limit (top-k with a tie key)."""
    if order_by:
        ties = [c for c in (tie_columns if tie_columns is not None else df.columns) if c != order_by]
        df = df.orderBy(F.col(order_by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties])
    if limit:
        df = df.limit(limit)
    return df


def chart_series(df: DataFrame, index_column: str) -> DataFrame:
    """Ascending by the index column, keeping ``events``."""
    return df.orderBy(F.col(index_column).asc_nulls_first()).select(index_column, "events")


def chart_top_n(df: DataFrame, index_column: str, top_n: int) -> DataFrame:
    """The ``top_n`` rows with most events (ties by the index column)."""
    return (
        df.orderBy(F.col("events").desc_nulls_last(), F.col(index_column).asc_nulls_first())
        .limit(top_n)
        .select(index_column, "events")
    )


def visible_recent_events(df: DataFrame, row_limit: int) -> DataFrame:
    """P10: the display columns that exist, first ``row_limit`` rows by time."""
    columns = [c for c in VISIBLE_RECENT_COLUMNS if c in df.columns]
    ordered = df
    if "event_datetime" in df.columns:
        ordered = df.orderBy(F.col("event_datetime").desc_nulls_last(), *[F.col(c) for c in columns[1:]])
    return ordered.select(*columns).limit(row_limit)


def selected_event_count(events_by_date: DataFrame) -> DataFrame:
    """Total events of the (filtered) by-date table; 0 when empty."""
    return events_by_date.agg(null_safe_long(F.sum("events")).alias("selected_events"))


def date_bounds(events_by_date: DataFrame, as_of: dt.datetime | dt.date | None = None) -> DataFrame:
    """A10: first and last event date; today (or ``as_of``) when empty."""
    today = clock_date(as_of)
    return events_by_date.agg(
        F.coalesce(F.min("event_date"), today).alias("min_date"),
        F.coalesce(F.max("event_date"), today).alias("max_date"),
    )


def latest_event_time(recent: DataFrame) -> DataFrame:
    """Latest event time; null when there is none."""
    return recent.agg(F.max("event_datetime").alias("latest_event"))


def _freshness_columns(latest: Column, stale_after_minutes: int, now: Column) -> dict[str, Column]:
    age_us = F.unix_micros(now) - F.unix_micros(latest)
    minutes = F.greatest(F.floor(age_us / F.lit(60_000_000)), F.lit(0)).cast("long")
    status = (
        F.when(latest.isNull(), F.lit("Unknown"))
        .when(age_us <= F.lit(stale_after_minutes * 60_000_000), F.lit("Fresh"))
        .otherwise(F.lit("Stale"))
    )
    detail = F.when(latest.isNull(), F.lit("No event timestamp available")).otherwise(
        F.concat(minutes.cast("string"), F.lit(" min old"))
    )
    return {"freshness": status, "freshness_detail": detail}


def freshness_status(
    recent: DataFrame,
    stale_after_minutes: int = DEFAULT_STALE_AFTER_MINUTES,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """V3: ``Fresh`` when the newest event is at most ``stale_after_minutes``
    old at ``as_of`` (default: now), else ``Stale``; ``Unknown`` without times.
    The status compares the exact age; the detail shows whole minutes."""
    latest = latest_event_time(recent)
    return latest.withColumns(
        _freshness_columns(F.col("latest_event"), stale_after_minutes, clock(as_of))
    )


def metric_cards(
    kpis: DataFrame,
    selected_events: DataFrame,
    recent: DataFrame,
    stale_after_minutes: int = DEFAULT_STALE_AFTER_MINUTES,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """V1: one row of headline figures.

    The three inputs are one-row frames; they are stacked and folded into a
    single row by one aggregate (each column comes from exactly one input).
    """
    totals = kpis.agg(
        null_safe_long(F.first("events")).alias("total_events"),
        null_safe_long(F.first("bot_events")).alias("bot_events"),
        null_safe_long(F.first("unique_users")).alias("unique_users"),
        null_safe_long(F.first("unique_pages")).alias("unique_pages"),
    )
    fresh = freshness_status(recent, stale_after_minutes, as_of).drop("latest_event")
    stacked = totals.unionByName(selected_events, allowMissingColumns=True).unionByName(
        fresh, allowMissingColumns=True
    )
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return row.select(
        "selected_events",
        "total_events",
        safe_percent("bot_events", "total_events").alias("bot_share_pct"),
        "unique_users",
        "unique_pages",
        "freshness",
        "freshness_detail",
    )


def readiness_panel(
    recent: DataFrame,
    stale_after_minutes: int = DEFAULT_STALE_AFTER_MINUTES,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """V2: (check, status, detail) rows for the KPI table, the newest event's
    freshness and the latest event time."""
    fresh = freshness_status(recent, stale_after_minutes, as_of)
    latest = F.col("latest_event")
    def row(check: Column, status: Column, detail: Column) -> Column:
        return F.struct(check.alias("check"), status.alias("status"), detail.alias("detail"))

    rows = F.array(
        row(F.lit("Gold KPI table"), F.lit("Ready"), F.lit("Loaded")),
        row(F.lit("Recent event timestamp"), F.col("freshness"), F.col("freshness_detail")),
        row(
            F.lit("Latest event time"),
            F.when(latest.isNull(), F.lit("Missing")).otherwise(F.lit("Available")),
            F.coalesce(latest.cast("string"), F.lit("")),
        ),
    )
    return fresh.select(F.inline(rows))


def load_dashboard_data(
    tables: Mapping[str, DataFrame],
    max_top_n: int = DEFAULT_MAX_TOP_N,
    max_recent_rows: int = DEFAULT_MAX_RECENT_ROWS,
) -> dict[str, DataFrame]:
    """V4: the eight serving reads, with top-n caps and sort orders."""
    def top(name: str, labels: Sequence[str]) -> DataFrame:
        return serving_order(tables[name], "events", max_top_n, tie_columns=labels)

    return {
        "kpis": tables["agg_dashboard_kpis"],
        "events_by_date": tables["agg_events_by_date"].orderBy("event_date"),
        "events_by_window": tables["agg_events_by_window"].orderBy("window_start", "event_date", "event_hour"),
        "events_by_type": top("agg_events_by_type", ["event_type"]),
        "events_by_wiki": top("agg_events_by_wiki", ["wiki"]),
        "top_users": top("agg_top_users", ["event_user", "is_bot"]),
        "top_pages": top("agg_top_pages", ["page_title", "namespace"]),
        "recent_events": serving_order(tables["recent_events_snapshot"], "event_datetime", max_recent_rows),
    }


def dashboard_views(
    data: Mapping[str, DataFrame],
    start: dt.date | None,
    end: dt.date | None,
    top_n: int,
    row_limit: int,
    stale_after_minutes: int = DEFAULT_STALE_AFTER_MINUTES,
    as_of: dt.datetime | None = None,
) -> dict[str, DataFrame]:
    """V5: the date filter applies to by-date, by-window and recent events;
    breakdowns are not date filtered."""
    by_date = filter_by_date_range(data["events_by_date"], "event_date", start, end)
    by_window = filter_by_date_range(data["events_by_window"], "event_date", start, end)
    recent = filter_by_date_range(data["recent_events"], "event_date", start, end)
    return {
        "metric_cards": metric_cards(
            data["kpis"], selected_event_count(by_date), recent, stale_after_minutes, as_of
        ),
        "events_by_date_chart": chart_series(by_date, "event_date"),
        "events_by_window_chart": chart_series(by_window, "window_start"),
        "event_types_chart": chart_top_n(data["events_by_type"], "event_type", top_n),
        "wikis_chart": chart_top_n(data["events_by_wiki"], "wiki", top_n),
        "top_users": serving_order(data["top_users"], "events", top_n, ["event_user", "is_bot"]),
        "top_pages": serving_order(data["top_pages"], "events", top_n, ["page_title", "namespace"]),
        "recent_events": visible_recent_events(recent, row_limit),
        "readiness": readiness_panel(data["recent_events"], stale_after_minutes, as_of),
    }
