"""Layer checks and the failure report (Q9-Q17).

Every metric is a row of a small DataFrame ``(check, metric, value, failed)``.
All metrics of one table come from one aggregate: the rows are grouped by the
table key once (partial aggregation map-side, one shuffle), and row count,
duplicate keys, null counts and flag counts are summed from those groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.quality import require_columns
from tributary.schemas import (
    BRONZE_KEY,
    DASHBOARD_REQUIRED_COLUMNS,
    GOLD_TABLES,
)

METRIC_SCHEMA = "check string, metric string, value long, failed boolean"
SILVER_REQUIRED_NOT_NULL = ("meta_id", "event_id", "event_type", "event_date", "wiki", "page_title")


class ChecksFailedError(RuntimeError):
    """One or more checks failed; the message lists all of them."""


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q9 (lazy): one row, ``duplicate_groups`` = key groups with more than one row."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.agg(F.count_if(F.col("_n") > 1).alias("duplicate_groups"))


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> int:
    """Q9: number of key groups with more than one row."""
    return duplicate_key_groups(df, keys).first()["duplicate_groups"]


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Q10: one row with ``null_<column>`` for each column, in one aggregate."""
    columns = list(columns) if columns is not None else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def null_count(df: DataFrame, column: str) -> int:
    return null_counts(df, [column]).first()[0]


def table_profile(
    df: DataFrame,
    keys: Sequence[str] | None,
    not_null: Sequence[str] = (),
    flags: Sequence[str] = (),
) -> DataFrame:
    """One row: ``rows``, ``duplicate_keys``, ``null_<c>`` and ``<flag>_rows``.

    With ``keys`` the table is grouped once by its key; a key shared by a third
    of the rows is summed map-side and reaches the shuffle as one row per task.
    """
    per_row = [
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
        *[F.count_if(F.col(c)).alias(f"{c}_rows") for c in flags],
    ]
    if not keys:
        return df.agg(F.count("*").alias("rows"), *per_row).withColumn(
            "duplicate_keys", F.lit(0).cast("long")
        )
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_n"), *per_row)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in grouped.columns
            if c not in keys and c != "_n"]
    return grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        *sums,
    )


def _metrics(profile: DataFrame, check: str, rules: Mapping[str, Column | None]) -> DataFrame:
    """Unpivot a one-row profile into metric rows; ``rules`` gives the failure test."""
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(name).alias("metric"),
            F.col(name).cast("long").alias("value"),
            (rule if rule is not None else F.lit(False)).alias("failed"),
        )
        for name, rule in rules.items()
    ]
    return profile.select(F.inline(F.array(*rows)))


def bronze_metrics(bronze: DataFrame) -> DataFrame:
    """Q11: rows > 0 and no duplicate (topic, partition, offset)."""
    profile = table_profile(bronze, BRONZE_KEY)
    return _metrics(
        profile,
        "bronze",
        {"rows": F.col("rows") == 0, "duplicate_keys": F.col("duplicate_keys") > 0},
    )


def silver_metrics(silver: DataFrame) -> DataFrame:
    """Q12: rows, duplicate meta_id, nulls in six columns, late rows (if present)."""
    flags = ["is_late_arriving"] if "is_late_arriving" in silver.columns else []
    return silver_report(table_profile(silver, ["meta_id"], SILVER_REQUIRED_NOT_NULL, flags))


def silver_report(profile: DataFrame) -> DataFrame:
    """Q12 from Silver's profile (one row, as ``table_profile`` gives it)."""
    rules = {"rows": F.col("rows") == 0, "duplicate_keys": F.col("duplicate_keys") > 0}
    rules.update({f"null_{c}": F.col(f"null_{c}") > 0 for c in SILVER_REQUIRED_NOT_NULL})
    rules.update({c: None for c in profile.columns if c.endswith("_rows")})
    return _metrics(profile, "silver", rules)


def quarantine_metrics(quarantine: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """Q13: rows and rows per category; a missing quarantine is not a failure."""
    if quarantine is None:
        if spark is None:
            raise ValueError("spark is needed to report a missing quarantine")
        return spark.createDataFrame(
            [("quarantine", "rows_unavailable", None, False)], METRIC_SCHEMA
        )
    per_category = quarantine.groupBy("quality_error_category").agg(
        F.count("*").alias("value")
    )
    categories = per_category.select(
        F.lit("quarantine").alias("check"),
        F.concat(F.lit("rows_"), F.coalesce("quality_error_category", F.lit("none"))).alias(
            "metric"
        ),
        F.col("value").cast("long"),
        F.lit(False).alias("failed"),
    )
    total = per_category.agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("rows"))
    return _metrics(total, "quarantine", {"rows": None}).unionByName(categories)


def gold_metrics(tables: Mapping[str, DataFrame], fact_profile: DataFrame | None = None) -> DataFrame:
    """Q14: every Gold table has rows; the fact key is unique; late fact rows.
    A given profile of the fact is taken instead of a pass over it."""
    frames = []
    for name in GOLD_TABLES:
        df = tables[name]
        if name == "fact_recent_changes":
            flags = ["is_late_arriving"] if "is_late_arriving" in df.columns else []
            profile = table_profile(df, ["recent_change_key"], flags=flags) if fact_profile is None else fact_profile
            rules = {"rows": F.col("rows") == 0, "duplicate_keys": F.col("duplicate_keys") > 0}
            rules.update({f"{c}_rows": None for c in flags})
        else:
            profile = df.agg(F.count("*").alias("rows"))
            rules = {"rows": F.col("rows") == 0}
        frames.append(_metrics(profile, f"gold_{name}", rules))
    return reduce(DataFrame.unionByName, frames)


def metrics_report(*frames: DataFrame) -> DataFrame:
    """Q15: all metrics as one frame (computed in one job when collected)."""
    return reduce(DataFrame.unionByName, frames)


def raise_on_failures(report: DataFrame | list[tuple]) -> list[tuple]:
    """Q15: collect the (few) metric rows, then raise once listing every failure."""
    if isinstance(report, DataFrame):
        report = [tuple(r) for r in report.collect()]  # one row per metric, bounded
    failures = [r for r in report if r[3]]
    if failures:
        lines = "\n".join(f"- {c}.{m} = {v}" for c, m, v, _ in failures)
        raise ChecksFailedError(f"Lakehouse quality checks failed:\n{lines}")
    return report


def dashboard_readiness(
    tables: Mapping[str, DataFrame], min_fact_rows: int = 1
) -> DataFrame:
    """Q17: required columns (metadata only), then one job for every table's
    row count and the KPI event total against ``min_fact_rows``."""
    for name, required in DASHBOARD_REQUIRED_COLUMNS.items():
        require_columns(tables[name], name, required)
    frames = [
        _metrics(tables[name].agg(F.count("*").alias("rows")), f"dashboard_{name}", {"rows": F.col("rows") == 0})
        for name in DASHBOARD_REQUIRED_COLUMNS
    ]
    kpis = tables["agg_dashboard_kpis"].agg(
        F.coalesce(F.sum("events"), F.lit(0)).cast("long").alias("total_events"),
        F.coalesce(F.sum("bot_events"), F.lit(0)).cast("long").alias("bot_events"),
        F.coalesce(F.sum("unique_users"), F.lit(0)).cast("long").alias("unique_users"),
        F.coalesce(F.sum("unique_pages"), F.lit(0)).cast("long").alias("unique_pages"),
    )
    frames.append(
        _metrics(
            kpis,
            "dashboard_kpis",
            {
                "total_events": F.col("total_events") < F.lit(min_fact_rows),
                "bot_events": None,
                "unique_users": None,
                "unique_pages": None,
            },
        )
    )
    return reduce(DataFrame.unionByName, frames)
