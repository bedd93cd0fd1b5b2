"""Gold from states that add and subtract (A1-A8, D3-D8 without a full rebuild).

Two kinds of state make every Gold table but the fact:

* per event date: its counts (``days``), its 15-minute windows (``windows``) and
  its latest events (``latest``, at most as many rows as the snapshot holds);
* per combination of a dimension's key and attributes: how many events carry it
  (``combinations`` of type, wiki, user and page).

A date's combinations can be taken off the totals and its new ones put on, so a
run reads the dates that changed and no others. A key whose last event is gone
leaves its dimension, which keeps the distinct counts exact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.time import calendar_parts, date_key
from tributary.operators.aggregates import (
    BREAKDOWNS,
    agg_events_by_window,
    key_combinations,
    labelled_counts,
    recent_events_snapshot,
)
from tributary.operators.silver import keep_one_per_key
from tributary.operators.star import add_star_schema_keys, build_fact_recent_changes
from tributary.schemas import SNAPSHOT_ROWS

#: Dimension of each breakdown: its key and attributes are the breakdown's.
DIMENSIONS = {
    "agg_events_by_type": "dim_event_type",
    "agg_events_by_wiki": "dim_wiki",
    "agg_top_users": "dim_user",
    "agg_top_pages": "dim_page",
}


def fact_of(silver: DataFrame, one_per_key: Callable[[DataFrame, str], DataFrame] = keep_one_per_key) -> DataFrame:
    """The fact rows of the dates in ``silver``."""
    return build_fact_recent_changes(add_star_schema_keys(silver), one_per_key)


def partial_states(silver: DataFrame, fact: DataFrame) -> dict[str, DataFrame]:
    """The states of the dates in ``silver`` (one row per ``meta_id``), each
    with its ``event_date``; ``fact`` holds the dates' fact rows. Three states
    read it, so it should be stored: it shuffles whole rows to be made."""
    events = add_star_schema_keys(silver)
    newest = Window.partitionBy("event_date").orderBy(F.col("event_datetime").desc_nulls_last(), "recent_change_key")
    states = {
        "days": fact.groupBy("event_date").agg(
            F.count("*").alias("events"), F.sum(F.when(F.col("is_bot"), 1).otherwise(0)).cast("long").alias("bot_events")
        ),
        "windows": agg_events_by_window(fact),
        "latest": fact.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= SNAPSHOT_ROWS).drop("_place"),
    }
    return states | {name: key_combinations(events, name, "event_date") for name in BREAKDOWNS}


def moved_totals(
    name: str, totals: DataFrame | None, removed: DataFrame, added: DataFrame
) -> DataFrame:
    """Totals of a breakdown's combinations after some dates' old combinations
    go and their new ones come; a combination without events is no more."""
    key, attributes, _ = BREAKDOWNS[name]
    columns = [key, *attributes, "_events"]
    parts = [added.select(*columns), removed.withColumn("_events", -F.col("_events")).select(*columns)]
    if totals is not None:
        parts.append(totals.select(*columns))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(key, *attributes).agg(F.sum("_events").alias("_events")).where(F.col("_events") != 0)


def dimension_of(name: str, totals: DataFrame) -> DataFrame:
    """D4-D7 from a breakdown's totals: per key its smallest combination."""
    key, attributes, _ = BREAKDOWNS[name]
    best = F.min(F.struct(*attributes, "_events")).alias("_best")
    return (
        totals.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(best)
        .select(key, *[F.col(f"_best.{a}").alias(a) for a in attributes])
    )


def gold_of_states(states: Mapping[str, DataFrame], totals: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The 13 Gold tables besides the fact, from all dates' states and the totals."""
    days = states["days"]
    dates = days.select(date_key("event_date").alias("date_key"), "event_date").where(F.col("event_date").isNotNull())
    tables = {"dim_date": dates.distinct().withColumns(calendar_parts("event_date"))}
    tables |= {DIMENSIONS[name]: dimension_of(name, totals[name]) for name in BREAKDOWNS}
    counted = days.agg(F.sum("events").alias("events"), F.sum("bot_events").alias("bot_events"))
    users, pages = (
        totals[name].agg(F.count_distinct(BREAKDOWNS[name][0]).alias(column))
        for name, column in (("agg_top_users", "unique_users"), ("agg_top_pages", "unique_pages"))
    )
    single = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (counted, users, pages))
    tables["agg_dashboard_kpis"] = single.agg(
        F.coalesce(F.max("events"), F.lit(0)).cast("long").alias("events"),
        *[F.max(c).alias(c) for c in ("bot_events", "unique_users", "unique_pages")],
    )
    tables["agg_events_by_date"] = days.select("event_date", "events")
    tables["agg_events_by_window"] = states["windows"].select("window_start", "window_end", "event_date", "event_hour", "events")
    tables |= {name: labelled_counts(totals[name], name) for name in BREAKDOWNS}
    tables["recent_events_snapshot"] = recent_events_snapshot(
        states["latest"], tables["dim_wiki"], tables["dim_page"], tables["dim_user"], tables["dim_event_type"]
    )
    return tables
