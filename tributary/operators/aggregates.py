"""Dashboard aggregates and the latest-events snapshot.

Label breakdowns (type, wiki, user, page) are counted per key on the fact
first and only then joined to the dimension: a dimension is unique on its key,
so ``count(*)`` grouped by label over ``fact ⟕ dim`` equals the sum of per-key
counts grouped by the key's label. The joins then see one row per key instead
of one row per event, and hot keys are already collapsed by partial
aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.keys import stable_key
from tributary.operators.star import DIMENSION_KEYS, LABELS, default_label, label, with_labels
from tributary.schemas import SNAPSHOT_COLUMNS, SNAPSHOT_ROWS, UNKNOWN_LABEL, WINDOW_DURATION


def agg_dashboard_kpis(fact: DataFrame) -> DataFrame:
    """A1: events, bot events (null on empty input), exact distinct users and pages."""
    return fact.agg(
        F.count("*").alias("events"),
        F.sum(F.when(F.col("is_bot"), 1).otherwise(0)).cast("long").alias("bot_events"),
        F.count_distinct("user_key").alias("unique_users"),
        F.count_distinct("page_key").alias("unique_pages"),
    )


def agg_events_by_date(fact: DataFrame) -> DataFrame:
    """A2: events per event date (sorted when served, not when stored)."""
    return fact.groupBy("event_date").agg(F.count("*").alias("events"))


def agg_events_by_window(fact: DataFrame, duration: str = WINDOW_DURATION) -> DataFrame:
    """A3: tumbling windows, half-open and epoch aligned; null times dropped."""
    span = F.window("event_datetime", duration)
    counted = fact.groupBy(span, "event_date", "event_hour").agg(F.count("*").alias("events"))
    bounds = [F.col(f"window.{end}").alias(f"window_{end}") for end in ("start", "end")]
    return counted.select(*bounds, "event_date", "event_hour", "events")


def _per_key(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(F.count("*").alias("_events"))


def _by_label(per_key: DataFrame, labels: list[str]) -> DataFrame:
    return (
        per_key.select(*[label(n) for n in labels], "_events")
        .groupBy(*labels)
        .agg(F.sum("_events").alias("events"))
    )


def agg_events_by_type(fact: DataFrame, dim_event_type: DataFrame) -> DataFrame:
    """A4: events per event type label."""
    per_key = with_labels(_per_key(fact, "event_type_key"), {"dim_event_type": dim_event_type})
    return _by_label(per_key, ["event_type"])


def agg_events_by_wiki(fact: DataFrame, dim_wiki: DataFrame) -> DataFrame:
    """A5: events per wiki label."""
    per_key = with_labels(_per_key(fact, "wiki_key"), {"dim_wiki": dim_wiki})
    return _by_label(per_key, ["wiki"])


def agg_top_users(fact: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Events per (user label, bot flag); no limit at build time."""
    per_key = with_labels(_per_key(fact, "user_key", "is_bot"), {"dim_user": dim_user})
    return _by_label(per_key, ["event_user", "is_bot"])


def agg_top_pages(fact: DataFrame, dim_page: DataFrame) -> DataFrame:
    """Events per (page title, namespace) label; no limit at build time."""
    per_key = with_labels(_per_key(fact, "page_key"), {"dim_page": dim_page})
    return _by_label(per_key, ["page_title", "namespace"])


#: Key, attributes and labels of the four breakdowns, as their dimensions hold them.
BREAKDOWNS = {
    "agg_events_by_type": ("event_type_key", ("event_type",), ("event_type",)),
    "agg_events_by_wiki": ("wiki_key", ("wiki", "domain", "server_name", "stream_name", "source_system"), ("wiki",)),
    "agg_top_users": ("user_key", ("event_user", "is_bot"), ("event_user", "is_bot")),
    "agg_top_pages": ("page_key", ("wiki_key", "namespace", "page_title", "page_url"), ("page_title", "namespace")),
}


def own_label(name: str) -> Column:
    """C15 on an event's own column."""
    return F.coalesce(F.col(name), default_label(LABELS[name][1])).alias(name)


def key_combinations(events: DataFrame, name: str, *by: str) -> DataFrame:
    """Events per combination of a breakdown's key and attributes, and ``by``."""
    key, attributes, _ = BREAKDOWNS[name]
    if "event_user" in attributes:
        events = events.withColumn("event_user", F.coalesce("event_user", F.lit(UNKNOWN_LABEL)))
    return events.groupBy(*by, key, *attributes).agg(F.count("*").alias("_events"))


def labelled_counts(combinations: DataFrame, name: str) -> DataFrame:
    """A4-A7 from the counts per combination: a key's smallest combination,
    which is the dimension's row, gives the label."""
    key, attributes, labels = BREAKDOWNS[name]
    per_key = combinations.groupBy(key).agg(
        F.min(F.struct(*attributes)).alias("_best"), F.sum("_events").alias("_events")
    )
    named = per_key.select(*[F.col(f"_best.{n}").alias(n) for n in labels], "_events")
    return named.groupBy(*[own_label(n) for n in labels]).agg(F.sum("_events").alias("events"))


def label_counts(events: DataFrame, name: str) -> DataFrame:
    """A4-A7 straight from keyed events with one row per ``meta_id``.

    The same rows as counting the fact per key and joining the dimension, in
    one pass over the events and without a join, for where the dimension isn't
    stored.
    """
    return labelled_counts(key_combinations(events, name), name)


def recent_events_of(events: DataFrame, rows: int = SNAPSHOT_ROWS) -> DataFrame:
    """L1 straight from keyed events with one row per ``meta_id``: the labels
    ride along with the top-k, so nothing is joined and the events are read
    once. They are the events' own attributes; a dimension says otherwise only
    where two different attribute tuples share a key (a value that holds the
    key separator or is the literal null token)."""
    return (
        events.select(
            stable_key("meta_id").alias("_key"), "event_datetime", "event_date", "comment",
            *[own_label(n) for n in ("event_type", "wiki", "page_title", "event_user", "is_bot", "namespace")],
        )
        .orderBy(F.col("event_datetime").desc_nulls_last(), "_key")
        .limit(rows)
        .select(*SNAPSHOT_COLUMNS)
    )


def _semi_filtered(lookup: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    # ``keys`` holds at most ``rows`` rows (a top-k result), so broadcasting it
    # has a proven size bound; the dimension is streamed, never shuffled.
    return lookup.join(F.broadcast(keys.select(key).distinct()), key, "left_semi")


def recent_events_snapshot(
    fact: DataFrame,
    dim_wiki: DataFrame,
    dim_page: DataFrame,
    dim_user: DataFrame,
    dim_event_type: DataFrame,
    rows: int = SNAPSHOT_ROWS,
    materialize=None,
) -> DataFrame:
    """L1: the latest ``rows`` events with their labels.

    Top-k runs on the fact (``TakeOrderedAndProject``: each task keeps ``rows``
    candidates), ties broken by ``recent_change_key`` so the result repeats.
    Labels are attached afterwards: each dimension is cut to the snapshot's keys
    by a broadcast semi-join, then joined to the ≤ ``rows`` snapshot rows.
    ``materialize`` (e.g. ``DataFrame.checkpoint``) computes the top-k once
    when the snapshot is reused by several joins.
    """
    top = (
        fact.select(
            "recent_change_key",
            "event_datetime",
            "event_date",
            "wiki_key",
            "page_key",
            "user_key",
            "event_type_key",
            "is_bot",
            "comment",
        )
        .orderBy(F.col("event_datetime").desc_nulls_last(), F.col("recent_change_key"))
        .limit(rows)
    )
    if materialize is not None:
        top = materialize(top)
    dimensions = {"dim_event_type": dim_event_type, "dim_wiki": dim_wiki, "dim_user": dim_user, "dim_page": dim_page}
    labelled = with_labels(top, {n: _semi_filtered(d, top, DIMENSION_KEYS[n]) for n, d in dimensions.items()})
    return labelled.select(
        "event_datetime",
        "event_date",
        label("event_type"),
        label("wiki"),
        label("page_title"),
        label("event_user"),
        label("is_bot"),
        label("namespace"),
        "comment",
    ).select(*SNAPSHOT_COLUMNS)


def build_dashboard_aggregates(
    fact: DataFrame,
    dim_wiki: DataFrame,
    dim_page: DataFrame,
    dim_user: DataFrame,
    dim_event_type: DataFrame,
    materialize=None,
) -> dict[str, DataFrame]:
    """The eight serving tables, lazily."""
    return {
        "agg_dashboard_kpis": agg_dashboard_kpis(fact),
        "agg_events_by_date": agg_events_by_date(fact),
        "agg_events_by_window": agg_events_by_window(fact),
        "agg_events_by_type": agg_events_by_type(fact, dim_event_type),
        "agg_events_by_wiki": agg_events_by_wiki(fact, dim_wiki),
        "agg_top_users": agg_top_users(fact, dim_user),
        "agg_top_pages": agg_top_pages(fact, dim_page),
        "recent_events_snapshot": recent_events_snapshot(
            fact, dim_wiki, dim_page, dim_user, dim_event_type, materialize=materialize
        ),
    }
