"""Null-safe numeric helpers and lenient date coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.util import as_column


def safe_percent(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator * 100``, ``0.0`` when the denominator is 0."""
    n, d = as_column(numerator), as_column(denominator)
    return F.when(d == 0, F.lit(0.0)).otherwise(n.cast("double") / d * 100.0)


def null_safe_long(value: Column | str) -> Column:
    """Null becomes 0."""
    return F.coalesce(as_column(value).cast("long"), F.lit(0).cast("long"))


def coerce_timestamp(value: Column | str) -> Column:
    """Timestamp or null for unparsable text."""
    column = as_column(value)
    return F.try_to_timestamp(column.cast("string"))


def coerce_date(value: Column | str) -> Column:
    """Date or null for unparsable text."""
    return F.to_date(coerce_timestamp(value))
