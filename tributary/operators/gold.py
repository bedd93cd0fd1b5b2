"""The whole Gold model as a dictionary of lazy frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tributary.operators.aggregates import (
    BREAKDOWNS,
    agg_dashboard_kpis,
    agg_events_by_date,
    agg_events_by_window,
    build_dashboard_aggregates,
    label_counts,
    recent_events_of,
)
from tributary.operators.silver import keep_one_per_key
from tributary.operators.star import (
    add_star_schema_keys,
    build_dimensions,
    build_fact_recent_changes,
)


def build_model(
    silver: DataFrame, one_per_key: Callable[[DataFrame, str], DataFrame] = keep_one_per_key
) -> dict[str, DataFrame]:
    """Silver -> 5 dimensions and the fact."""
    modeled = add_star_schema_keys(silver)
    tables = build_dimensions(modeled)
    tables["fact_recent_changes"] = build_fact_recent_changes(modeled, one_per_key)
    return tables


def build_serving_tables(model: Mapping[str, DataFrame], materialize=None) -> dict[str, DataFrame]:
    """Fact and dimensions -> the 8 serving tables."""
    return build_dashboard_aggregates(
        model["fact_recent_changes"],
        model["dim_wiki"],
        model["dim_page"],
        model["dim_user"],
        model["dim_event_type"],
        materialize=materialize,
    )


def serving_tables_of(silver: DataFrame) -> dict[str, DataFrame]:
    """The 8 serving tables straight from Silver (one row per ``meta_id``),
    each in one pass over it; for queries that store no model."""
    events = add_star_schema_keys(silver)
    fact = build_fact_recent_changes(events)
    tables = {
        "agg_dashboard_kpis": agg_dashboard_kpis(fact),
        "agg_events_by_date": agg_events_by_date(fact),
        "agg_events_by_window": agg_events_by_window(fact),
    }
    tables |= {name: label_counts(events, name) for name in BREAKDOWNS}
    return tables | {"recent_events_snapshot": recent_events_of(events)}


def build_star_schema(silver: DataFrame, materialize=None) -> dict[str, DataFrame]:
    """Silver -> 5 dimensions, the fact and the 8 serving tables (14 frames)."""
    model = build_model(silver)
    return model | build_serving_tables(model, materialize)
