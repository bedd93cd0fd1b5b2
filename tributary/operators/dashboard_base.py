"""The dashboard base straight from Silver (J1-J5): labels without shuffling an event.

Every label is a part of its key: the wiki's name of ``wiki_key``, title and
namespace of ``page_key``, and so on. So an event holds the label that its
dimension holds, unless two different tuples of parts share a key. Those can
only hold a null, the null token or a character of the key separator: else the
text behind the key has one reading. Events with such parts are grouped per
key, and the few keys that more than one label claims are attached as the
dimension says: as a broadcast after their count is known, by a join beyond
that bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.aggregates import BREAKDOWNS, key_combinations, own_label
from tributary.operators.star import (
    DASHBOARD_KEPT,
    DASHBOARD_TIMES,
    DIMENSION_KEYS,
    KEY_PARTS,
    LABELS,
    add_star_schema_keys,
    label,
)
from tributary.schemas import KEY_SEPARATOR, NULL_KEY_TOKEN

#: Disputed keys of a dimension that are broadcast.
BROADCAST_KEYS = 10_000
_BREAKDOWN_OF = {
    "dim_event_type": "agg_events_by_type", "dim_wiki": "agg_events_by_wiki",
    "dim_user": "agg_top_users", "dim_page": "agg_top_pages",
}


def _shares_key(parts: tuple[str, ...]) -> Column:
    """Could another tuple of parts have this event's key?"""
    texts = [F.col(p).cast("string") for p in parts]
    marks = [t.contains(c) for t in texts for c in sorted(set(KEY_SEPARATOR))]
    return reduce(Column.__or__, [t.isNull() for t in texts] + [t == NULL_KEY_TOKEN for t in texts] + marks)


def disputed_labels(events: DataFrame, dimension: str) -> DataFrame:
    """(key, labels): keys that events with different labels share, with the
    labels of the dimension's row, the smallest combination, as a struct named
    after the dimension."""
    key = DIMENSION_KEYS[dimension]
    _, attributes, _ = BREAKDOWNS[_BREAKDOWN_OF[dimension]]
    labels = F.struct(*[n for n, (source, _) in LABELS.items() if source == dimension])
    odd = events.where(F.coalesce(_shares_key(KEY_PARTS[key]), F.lit(True)))
    per_key = key_combinations(odd, _BREAKDOWN_OF[dimension]).groupBy(key).agg(
        F.min(F.struct(F.struct(*attributes).alias("row"), labels.alias("labels"))).alias("best"),
        F.min(labels).alias("least"),
        F.max(labels).alias("most"),
    )
    return per_key.where(~F.col("least").eqNullSafe(F.col("most"))).select(key, F.col("best.labels").alias(dimension))


def dashboard_base_of(silver: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """J5 from Silver with one row per ``meta_id``.

    The events are read once for each dimension's disputed keys (key columns of
    events that could share one; up to ``broadcast_keys`` + 1 rows come to the
    driver) and once for the result, whose plan has no exchange of the events
    while the disputed keys of a dimension stay within the bound.
    """
    events = add_star_schema_keys(silver).withColumn("event_hour", F.hour("event_datetime"))
    rows, disputed = events, set()
    for dimension, key in DIMENSION_KEYS.items():
        found = disputed_labels(events, dimension)
        few = found.limit(broadcast_keys + 1).collect()
        if not few:
            continue
        disputed.add(dimension)
        if len(few) <= broadcast_keys:
            found = F.broadcast(silver.sparkSession.createDataFrame(few, found.schema))
        rows = rows.join(found, key, "left")

    def labelled(name: str) -> Column:
        dimension = LABELS[name][0]
        if dimension not in disputed:
            return own_label(name)
        return F.when(F.col(dimension).isNotNull(), label(name)).otherwise(own_label(name)).alias(name)

    return rows.select(*DASHBOARD_TIMES, *map(labelled, LABELS), *DASHBOARD_KEPT)
