"""Layer checks from state (Q9, Q11-Q14 without regrouping whole layers).

A manifest per layer holds, for each event date, the files that the date held
and its counts: rows, nulls of the required columns, flagged rows. A date whose
folder holds other files has changed and is counted anew; the others' counts
stand. Keys are unique over all dates, so their duplicates come from the key
index (``key_index.py``), which is brought up to date from the same dates and
counted bucket by bucket. A run that stops before its manifest is published is
repeated from the same start.

The other tables' row counts come from the files' footers and need no state.
Bronze, whose key is not bound to a date, and layers that aren't partitioned by
event date are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.checks import (
    SILVER_REQUIRED_NOT_NULL,
    bronze_metrics,
    gold_metrics,
    metrics_report,
    quarantine_metrics,
    silver_report,
    table_profile,
)
from tributary.plans.jobs import LakeConfig, read_gold_tables
from tributary.plans.key_index import KeyIndex
from tributary.sinks.manifest import Manifest
from tributary.sources.dates import NULL_DATE, changed_dates, date_files, on_dates
from tributary.sources.lake import has_data_files, partition_columns, read_bronze, read_layer

_FLAG = "is_late_arriving"
_FACT = "fact_recent_changes"


@dataclass
class LayerProfile:
    """A layer's profile (one row, as ``table_profile`` gives it), and the dates
    that were read for it."""

    profile: DataFrame
    read: list[str]


def profile_by_dates(
    layer: DataFrame, path: str, state_path: str, index: KeyIndex, not_null: Sequence[str], flags: Sequence[str]
) -> LayerProfile:
    """The profile of the layer at ``path``, reading the dates that changed
    since the last one (at most one row of counts per date is collected)."""
    spark = layer.sparkSession
    counts = [F.count("*").alias("rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    counts += [F.count_if(F.col(c)).alias(f"{c}_rows") for c in flags]
    names = ["rows", *[f"null_{c}" for c in not_null], *[f"{c}_rows" for c in flags]]

    manifest = Manifest(spark, f"{state_path}/manifest")
    before = manifest.current() or {"names": names, "dates": {}}
    held = before["dates"] if before["names"] == names else {}  # other counts were asked for
    found = date_files(spark, path)
    changed, gone = changed_dates(found, held)
    dates = {d: held[d] for d in held.keys() & found.keys() - set(changed)}
    if changed:
        rows = layer.where(on_dates(changed)).groupBy("event_date").agg(*counts).collect()
        own = {NULL_DATE if r.event_date is None else str(r.event_date): [r[n] for n in names] for r in rows}
        # A date of files without rows has no group.
        dates |= {d: {"files": found[d], "counts": own.get(d, [0] * len(names))} for d in changed}
    if changed or gone:
        manifest.publish({"names": names, "dates": dates})
    sums = [sum(column) for column in zip(*[v["counts"] for v in dates.values()], strict=True)] or [0] * len(names)
    values = [sums[0], index.duplicates(), *sums[1:]]
    fields = ", ".join(f"`{n}` long" for n in ["rows", "duplicate_keys", *names[1:]])
    return LayerProfile(spark.createDataFrame([values], fields), changed)


def _profile(spark: SparkSession, config: LakeConfig, name: str) -> LayerProfile:
    """The profile of Silver or the fact."""
    silver = name == "silver"
    key, not_null = ("meta_id", SILVER_REQUIRED_NOT_NULL) if silver else ("recent_change_key", ())
    path = config.path("silver") if silver else config.path("gold", name)
    kind = config.format_of("silver" if silver else "gold")
    partitions = config.silver_partitions if silver else config.gold_partitions.get(name, "")
    state = config.path("check_state", name)
    layer = read_layer(spark, path, kind)
    flags = [_FLAG] if _FLAG in layer.columns else []
    if partition_columns(partitions) != ["event_date"]:
        return LayerProfile(table_profile(layer, [key], not_null, flags), [])
    index = KeyIndex(spark, config.path("silver_keys") if silver else f"{state}/keys", path, kind, key)
    return profile_by_dates(layer, path, state, index, not_null, flags)


def lake_metrics_by_state(
    spark: SparkSession, config: LakeConfig, skip_bronze: bool = False
) -> tuple[DataFrame, dict[str, list[str]]]:
    """The metric rows of ``jobs.lake_metrics``, and the dates of Silver and the
    fact that were read for them."""
    silver, fact = _profile(spark, config, "silver"), _profile(spark, config, _FACT)
    frames = []
    if not skip_bronze:
        frames.append(bronze_metrics(read_bronze(spark, config.path("bronze"), config.format_of("bronze"))))
    path = config.path("quarantine")
    quarantine = (
        read_layer(spark, path, config.format_of("quarantine")) if has_data_files(spark, path) else None
    )
    report = metrics_report(
        *frames,
        silver_report(silver.profile),
        quarantine_metrics(quarantine, spark),
        gold_metrics(read_gold_tables(spark, config), fact.profile),
    )
    return report, {"silver": silver.read, _FACT: fact.read}
