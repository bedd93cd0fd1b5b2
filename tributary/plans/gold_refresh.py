"""Silver -> Gold from the dates that changed.

The state of Gold lies under ``gold_state_path``: per run the partial states of
the dates it read (``dates/<run>/<state>``, partitioned by event date) and the
totals of the breakdowns' combinations (``totals/<run>/<breakdown>``), and a
manifest that says, for each Silver date, which files it held and which run has
its states. A date whose folder holds other files than that has changed: every
write names its files anew, so no order of runs and no stopped run can hide one.

A refresh reads the changed dates of Silver and nothing else of it. Old states
of those dates come off the totals, new ones go on; the other dates' states are
small (a row per date, its windows, its latest rows). The changed dates' fact is
written first, and the states of a date come from it: its rows are made and
deduplicated once. Every table follows from the previous manifest's states and
the changed dates, so a run that stops before its manifest is published is
repeated from the same start.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tributary.operators.aggregates import BREAKDOWNS
from tributary.operators.gold_state import fact_of, gold_of_states, moved_totals, partial_states
from tributary.operators.silver import one_per_repeated_key
from tributary.plans.jobs import LakeConfig, run_silver_to_gold
from tributary.sinks.lake import LayerWriter, run_concurrently, write_tables
from tributary.sinks.manifest import Manifest
from tributary.sources.dates import DATE_FOLDER, changed_dates, date_files, on_dates
from tributary.sources.lake import child_folders, delete_folder, has_data_files, partition_columns, read_layer

_DAY_STATES = ("days", "windows", "latest")
_FACT = "fact_recent_changes"


@dataclass
class GoldRefresh:
    """Paths of the tables, the dates read, and the dates that are gone."""

    paths: dict[str, str]
    changed: list[str]
    gone: list[str]


class GoldState:
    """Reads and writes below ``gold_state_path``."""

    def __init__(self, spark: SparkSession, config: LakeConfig) -> None:
        self.spark = spark
        self.root = config.path("gold_state")
        self.manifest = Manifest(spark, f"{self.root}/manifest")

    def states(self, name: str, runs: dict[str, str], schema: StructType) -> DataFrame | None:
        """A per-date state of the dates in ``runs`` (date -> run), read from
        those dates' folders only."""
        by_run: dict[str, list[str]] = {}
        for date, run in runs.items():
            by_run.setdefault(run, []).append(date)
        parts = [
            self.spark.read.schema(schema).parquet(f"{self.root}/dates/{run}/{name}").where(on_dates(dates))
            for run, dates in sorted(by_run.items())
        ]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def totals(self, name: str, run: str | None) -> DataFrame | None:
        return None if run is None else self.spark.read.parquet(f"{self.root}/totals/{run}/{name}")


def refresh_gold(spark: SparkSession, config: LakeConfig) -> GoldRefresh:
    """Bring Gold up to date with Silver (W3), reading the changed dates.

    The first run, and one after the state was removed, reads every date.
    Silver that isn't partitioned by event date has no dates to tell apart and
    gets the full rebuild.
    """
    if partition_columns(config.silver_partitions) != ["event_date"]:
        return GoldRefresh(run_silver_to_gold(spark, config), [], [])
    state = GoldState(spark, config)
    before = state.manifest.current() or {"dates": {}, "totals": None}
    held = before["dates"]
    silver = date_files(spark, config.path("silver"))
    changed, gone = changed_dates(silver, held)
    if not changed and not gone and before["totals"] is not None:
        return GoldRefresh({}, [], [])

    run = uuid.uuid4().hex
    layer = read_layer(spark, config.path("silver"), config.format_of("silver"))
    moved = layer.where(on_dates(changed))
    fact_path = _move_fact(spark, config, moved, changed, gone, first=before["totals"] is None)
    partials = partial_states(moved, _stored_fact(spark, config, fact_of(moved), changed))
    partitions = config.gold_partitions
    write_tables(
        LayerWriter(f"{state.root}/dates/{run}", mode="overwrite"), partials, dict.fromkeys(partials, "event_date")
    )

    dates = {d: held[d] for d in held.keys() & silver.keys() - set(changed)}
    dates |= {d: {"files": silver[d], "run": run} for d in changed}
    old_runs = {d: held[d]["run"] for d in [*changed, *gone] if d in held}
    new_runs = dict.fromkeys(changed, run)

    def of_dates(name: str, runs: dict[str, str]) -> DataFrame:
        schema = partials[name].schema
        found = state.states(name, runs, schema)
        return spark.createDataFrame([], schema) if found is None else found

    totals = {
        name: moved_totals(name, state.totals(name, before["totals"]), of_dates(name, old_runs), of_dates(name, new_runs))
        for name in BREAKDOWNS
    }
    write_tables(LayerWriter(f"{state.root}/totals/{run}", mode="overwrite"), totals, {})
    written = {name: state.totals(name, run) for name in BREAKDOWNS}
    days = {name: of_dates(name, {d: v["run"] for d, v in dates.items()}) for name in _DAY_STATES}
    gold = config.writer("gold")
    paths = write_tables(gold, gold_of_states(days, written), partitions) | fact_path
    state.manifest.publish({"dates": dates, "totals": run})
    _remove_unused(spark, state, before, dates)
    return GoldRefresh(paths, changed, gone)


def _move_fact(
    spark: SparkSession, config: LakeConfig, moved: DataFrame, changed: list[str], gone: list[str], first: bool
) -> dict[str, str]:
    """Replace the changed dates of the stored fact (``moved``: their Silver),
    and drop those that are gone."""
    spec = config.gold_partitions.get(_FACT, "")
    date = ["event_date"]
    by_date = partition_columns(spec) == date
    if first or not by_date:
        silver = moved if first else read_layer(spark, config.path("silver"), config.format_of("silver"))
        with one_per_repeated_key(silver, "meta_id", by=date if by_date else ()) as one_per_key:
            fact = fact_of(silver, one_per_key)
            return write_tables(config.writer("gold"), {_FACT: fact}, {_FACT: spec}, dealt={_FACT} if by_date else ())
    if changed:
        config.writer("gold", overwrite_partitions="dynamic").write(fact_of(moved), child=_FACT, partition_by=spec)
    for date in gone:
        delete_folder(spark, f"{config.path('gold', _FACT)}/{DATE_FOLDER}{date}")
    return {_FACT: config.path("gold", _FACT)}


def _stored_fact(spark: SparkSession, config: LakeConfig, fact: DataFrame, changed: list[str]) -> DataFrame:
    """The rows of ``fact``, the changed dates' fact, as just written. A Gold
    that isn't replaced by its writes holds others as well."""
    path = config.path("gold", _FACT)
    if config.mode_of("gold") != "overwrite" or not has_data_files(spark, path):
        return fact
    stored = read_layer(spark, path, config.format_of("gold"), fact.schema)
    return stored.where(on_dates(changed)).select(*fact.columns)


def _remove_unused(spark: SparkSession, state: GoldState, before: dict, dates: dict) -> None:
    """Delete totals and states that neither the new nor the previous manifest names."""
    runs = {v["run"] for v in [*dates.values(), *before["dates"].values()]}
    totals = {before["totals"], (state.manifest.current() or {}).get("totals")}

    def drop(kind: str, used: set) -> None:
        for run in set(child_folders(spark, f"{state.root}/{kind}")) - used:
            delete_folder(spark, f"{state.root}/{kind}/{run}")

    run_concurrently({"dates": lambda: drop("dates", runs), "totals": lambda: drop("totals", totals)})
