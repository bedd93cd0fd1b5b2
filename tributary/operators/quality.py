"""Schema check, quality classification, processing window and split."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import is_blank
from tributary.functions.time import arrival_lag_days, clock, clock_date, event_time
from tributary.schemas import (
    CATEGORY_BAD_TIMESTAMP,
    CATEGORY_MISSING_FIELD,
    CATEGORY_PARSE_FAILED,
    CATEGORY_RAW_MISSING,
    DEFAULT_LATE_ARRIVAL_DAYS,
    LOADED_COLUMNS,
    QUALITY_RULE_VERSION,
    QUARANTINE_COLUMNS,
    REASON_BAD_TIMESTAMP,
    REASON_MISSING_FIELD,
    REASON_PARSE_FAILED,
    REASON_RAW_MISSING,
    REQUIRED_FIELDS,
    REQUIRED_TEXT_FIELDS,
)


class SchemaMismatchError(RuntimeError):
    """A frame lacks columns a later step needs."""


def require_columns(df: DataFrame, name: str, required: Iterable[str]) -> None:
    """Raise with the sorted missing names (Q1, Q16); metadata only, no job."""
    missing = set(required) - set(df.columns)
    if missing:
        raise SchemaMismatchError(f"{name} is missing columns: {', '.join(sorted(missing))}")


def validate_loaded_schema(loaded: DataFrame) -> None:
    """Q1: the parsed table must carry all 26 columns."""
    require_columns(loaded, "Loaded dataframe schema", LOADED_COLUMNS)


def _field_missing(name: str) -> Column:
    column = F.col(name)
    return is_blank(column) if name in REQUIRED_TEXT_FIELDS else column.isNull()


def missing_required_condition() -> Column:
    """Any required field null (text fields: also blank after trim)."""
    return reduce(lambda a, b: a | b, (_field_missing(n) for n in REQUIRED_FIELDS))


def missing_required_field_names() -> Column:
    """Q2: comma list of missing required fields in rule order; ``''`` if none."""
    return F.concat_ws(",", *[F.when(_field_missing(n), F.lit(n)) for n in REQUIRED_FIELDS])


def _raw_missing() -> Column:
    return is_blank("raw_message")


def _parse_failed() -> Column:
    all_ids_null = reduce(
        lambda a, b: a & b,
        [F.col(c).isNull() for c in ("meta_id", "event_id", "event_type", "wiki", "page_title")],
    )
    return ~_raw_missing() & all_ids_null


def prepare_for_quality_checks(
    loaded: DataFrame,
    late_arrival_days: int = DEFAULT_LATE_ARRIVAL_DAYS,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Q7: derive event time, lag, late flag, window date and error category.

    Narrow projections only (no shuffle). ``as_of`` fixes the audit clock for
    repeatable runs; by default the query start time is used.
    """
    validate_loaded_schema(loaded)
    timed = loaded.withColumns(
        {
            "parsed_event_datetime": event_time("event_datetime", "event_unix_timestamp"),
            "bronze_ingested_date": F.to_date("bronze_ingested_at"),
            "quality_checked_at": clock(as_of),
            "quality_checked_date": clock_date(as_of),
        }
    ).withColumn("event_date", F.to_date("parsed_event_datetime"))
    lagged = timed.withColumn(
        "arrival_lag_days", arrival_lag_days("bronze_ingested_date", "event_date")
    )
    category = (
        F.when(_raw_missing(), F.lit(CATEGORY_RAW_MISSING))
        .when(_parse_failed(), F.lit(CATEGORY_PARSE_FAILED))
        .when(missing_required_condition(), F.lit(CATEGORY_MISSING_FIELD))
        .when(F.col("parsed_event_datetime").isNull(), F.lit(CATEGORY_BAD_TIMESTAMP))
    )
    classified = lagged.withColumns(
        {
            "is_late_arriving": F.coalesce(
                F.col("arrival_lag_days") > F.lit(late_arrival_days), F.lit(False)
            ),
            "processing_window_date": F.coalesce(
                "event_date", "bronze_ingested_date", "quality_checked_date"
            ),
            "quality_rule_version": F.lit(QUALITY_RULE_VERSION),
            "missing_required_fields": missing_required_field_names(),
            "quality_error_category": category,
        }
    )
    cat = F.col("quality_error_category")
    reason = (
        F.when(cat == CATEGORY_RAW_MISSING, F.lit(REASON_RAW_MISSING))
        .when(cat == CATEGORY_PARSE_FAILED, F.lit(REASON_PARSE_FAILED))
        .when(
            cat == CATEGORY_MISSING_FIELD,
            F.coalesce(F.col("missing_required_fields"), F.lit(REASON_MISSING_FIELD)),
        )
        .when(cat == CATEGORY_BAD_TIMESTAMP, F.lit(REASON_BAD_TIMESTAMP))
    )
    return classified.withColumn("quality_error_reason", reason)


def _as_date(value: dt.date | str | None, name: str) -> dt.date | None:
    if value is None or isinstance(value, dt.date):
        return value
    try:
        return dt.date.fromisoformat(value)
    except ValueError as exc:
        raise ValueError(f"{name} must be a yyyy-mm-dd date, got {value!r}") from exc


def window_bounds(
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    lookback_days: int | None = None,
    as_of: dt.datetime | dt.date | None = None,
) -> tuple[Column | None, Column | None]:
    """Inclusive bounds of a processing window; None where it is open.

    The look-back (``>= today - n``) applies only when neither bound is set.
    Bounds are real dates, so a malformed value fails before any job runs.
    """
    start, end = _as_date(start, "start"), _as_date(end, "end")
    first = None if start is None else F.lit(start)
    if start is None and end is None and lookback_days is not None:
        first = F.date_sub(clock_date(as_of), lookback_days)
    return first, None if end is None else F.lit(end)


def apply_processing_window(
    df: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    lookback_days: int | None = None,
    as_of: dt.datetime | dt.date | None = None,
) -> DataFrame:
    """Inclusive bounds on ``processing_window_date``."""
    first, last = window_bounds(start, end, lookback_days, as_of)
    if first is not None:
        df = df.where(F.col("processing_window_date") >= first)
    if last is not None:
        df = df.where(F.col("processing_window_date") <= last)
    return df


def split_valid_and_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without an error category go on; the rest go to quarantine."""
    category = F.col("quality_error_category")
    return df.where(category.isNull()), df.where(category.isNotNull())


def select_quarantine_columns(df: DataFrame) -> DataFrame:
    """P5: raw and parsed context of a rejected record (28 columns)."""
    return df.select(*QUARANTINE_COLUMNS)


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """Rows per error category (one partial+final aggregate)."""
    return quarantine.groupBy("quality_error_category").agg(F.count("*").alias("rows"))


class QuarantineGateError(RuntimeError):
    """Strict mode: some records went to quarantine (Q8)."""


def enforce_strict_quality(quarantine_rows: int | None, strict: bool) -> None:
    """Q8: raise after the writes when strict and the quarantine is not empty."""
    if strict and quarantine_rows:
        raise QuarantineGateError(
            f"Data quality failed. {quarantine_rows} record(s) went to quarantine."
        )
