"""Jobs: Kafka -> Bronze, Bronze -> Silver + quarantine, Silver -> Gold,
checks, and the scheduled order (W2-W6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tributary.operators.checks import (
    bronze_metrics,
    dashboard_readiness,
    gold_metrics,
    metrics_report,
    quarantine_metrics,
    raise_on_failures,
    silver_metrics,
)
from tributary.operators.gold import build_model, build_serving_tables
from tributary.operators.quality import (
    apply_processing_window,
    enforce_strict_quality,
    prepare_for_quality_checks,
    select_quarantine_columns,
    split_valid_and_quarantine,
    window_bounds,
)
from tributary.operators.silver import keep_one_per_key, one_per_repeated_key, transform_to_silver
from tributary.schemas import (
    BRONZE_KEY,
    BRONZE_PARTITIONS,
    BRONZE_SCHEMA,
    DASHBOARD_TABLES,
    DEFAULT_LATE_ARRIVAL_DAYS,
    GOLD_PARTITIONS,
    GOLD_TABLES,
    QUARANTINE_PARTITIONS,
    SILVER_PARTITIONS,
)
from tributary.plans.key_index import KeyIndex
from tributary.session import cut_lineage
from tributary.sinks.lake import LayerWriter, run_concurrently, write_tables
from tributary.sources.dates import DATE_FOLDER
from tributary.sources.kafka import parse_raw_messages, to_bronze
from tributary.sources.lake import (
    BRONZE_BATCH,
    BRONZE_STREAM,
    child_folders,
    delete_folder,
    file_names,
    folder_size,
    has_data_files,
    has_sink_log,
    lake_path,
    partition_columns,
    read_bronze,
    read_gold_table,
    read_layer,
)


@dataclass(frozen=True)
class LakeConfig:
    """Where each layer lives and how it is written.

    ``base_uri`` is any Hadoop file system URI (``file:/…``, ``abfss://…``,
    ``s3a://…``); credentials belong in the Spark configuration.
    ``layer_format`` holds for every layer that ``formats`` does not name, and
    ``modes`` replaces a layer's write mode (Bronze appends, the others
    overwrite).
    """

    base_uri: str
    bronze_path: str = "bronze/recent_changes"
    silver_path: str = "silver/recent_changes"
    quarantine_path: str = "quarantine/recent_changes"
    gold_path: str = "gold/recent_changes"
    bronze_checkpoint_path: str = "checkpoints/bronze"
    bronze_windows_path: str = "checkpoints/bronze_windows"
    bronze_offsets_path: str = "checkpoints/bronze_offsets"
    gold_state_path: str = "checkpoints/gold_state"
    silver_keys_path: str = "checkpoints/silver_keys"
    check_state_path: str = "checkpoints/check_state"
    layer_format: str = "parquet"
    bronze_partitions: str = BRONZE_PARTITIONS
    silver_partitions: str = SILVER_PARTITIONS
    quarantine_partitions: str = QUARANTINE_PARTITIONS
    gold_partitions: dict = field(default_factory=lambda: dict(GOLD_PARTITIONS))
    formats: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)

    def format_of(self, layer: str) -> str:
        return self.formats.get(layer, self.layer_format)

    def mode_of(self, layer: str) -> str:
        return self.modes.get(layer, "append" if layer == "bronze" else "overwrite")

    def writer(self, layer: str, child: str | None = None, overwrite_partitions: str | None = None) -> LayerWriter:
        partitions = "" if layer == "gold" else getattr(self, f"{layer}_partitions")
        return LayerWriter(
            self.path(layer, child), self.format_of(layer), self.mode_of(layer), partitions, overwrite_partitions
        )

    def path(self, layer: str, child: str | None = None) -> str:
        return lake_path(self.base_uri, getattr(self, f"{layer}_path"), child)


# --- W4 ----------------------------------------------------------------------

def run_kafka_to_bronze(
    spark: SparkSession,
    config: LakeConfig,
    kafka_df: DataFrame,
    only_new_offsets: bool = False,
    ingested_at=None,
) -> str:
    """Batch landing of Kafka records.

    The batch reader rereads a topic from earliest; with ``only_new_offsets``
    records whose (topic, partition, offset) is already in Bronze, landed by
    a batch or by the stream, are skipped (left anti join on the Bronze key),
    so reruns do not duplicate Bronze. Batches and the stream write to folders
    of their own below the Bronze path.
    """
    bronze = to_bronze(kafka_df, ingested_at)
    if only_new_offsets and has_data_files(spark, config.path("bronze")):
        landed = read_bronze(spark, config.path("bronze"), config.format_of("bronze"))
        bronze = bronze.join(landed_from(landed, lowest_offsets(bronze)), list(BRONZE_KEY), "left_anti")
    return config.writer("bronze", BRONZE_BATCH).write(bronze)


def start_kafka_to_bronze_stream(
    spark: SparkSession,
    config: LakeConfig,
    kafka_stream: DataFrame,
    trigger_interval: str | None = None,
    available_now: bool = False,
):
    """Continuous landing (W4 ``--stream``, T1-T3): append to Bronze with the
    offsets checkpointed next to it; returns the running query."""
    from tributary.streaming import start_bronze_stream

    return start_bronze_stream(
        kafka_stream,
        config.path("bronze", BRONZE_STREAM),
        config.path("bronze_checkpoint"),
        trigger_interval=trigger_interval,
        available_now=available_now,
        output_format=config.format_of("bronze"),
        partition_by=config.bronze_partitions,
    )


def lowest_offsets(bronze: DataFrame) -> list[Row]:
    """Lowest offset per (topic, partition) of a batch: one row per Kafka
    partition of the subscription, a bound set by the topic configuration."""
    return bronze.groupBy("kafka_topic", "kafka_partition").agg(F.min("kafka_offset").alias("lowest")).collect()


def landed_from(landed: DataFrame, lowest: list[Row]) -> DataFrame:
    """Keys of Bronze that a batch with these lowest offsets can meet.

    The bounds are literals on one topic at a time (a partition filter), so
    Parquet row groups below them are skipped. Offsets that arrive after the
    bounds were taken lie above them; a topic or partition without a bound is
    kept whole.
    """
    topic, partition, offset = F.col("kafka_topic"), F.col("kafka_partition"), F.col("kafka_offset")
    bounds: dict[str, dict[int, int]] = {}
    for row in lowest:
        bounds.setdefault(row.kafka_topic, {})[row.kafka_partition] = row.lowest
    parts = [landed.where(~topic.isin(list(bounds)))]
    for name, own in bounds.items():
        met = ~partition.isin(list(own))
        for number, first in own.items():
            met = met | ((partition == number) & (offset >= first))
        parts.append(landed.where((topic == name) & met))
    return reduce(DataFrame.unionByName, parts).select(*BRONZE_KEY)


# --- W2 ----------------------------------------------------------------------

def bronze_in_window(
    spark: SparkSession, bronze: DataFrame, records: list[Row], first: Column | None, last: Column | None
) -> DataFrame:
    """Bronze without the ingest dates that hold no row of the window, as far
    as their records say; a partition filter of the scan."""
    skip = _dates_to_skip(spark, records, first, last) if records else []
    day = F.col("bronze_ingested_date")
    return bronze.where(day.isNull() | ~day.isin(skip)) if skip else bronze


@dataclass
class SilverRun:
    silver_path: str
    quarantine_path: str
    quarantine_rows: int


# What each Bronze ingest date holds, so that a windowed run can leave out the
# dates that can't meet its window. ``files`` and ``bytes`` are the size of the
# date's folders when its rows were read (of a stream's folder, the number of
# committed files): landing only ever adds files, so a record with another size
# is out of date and its date is read again.
FOLDER_DATE = "_folder_date"
WINDOW_RECORD = "bronze_ingested_date date, files long, bytes long, first_date date, last_date date"


def _landed_dates(spark: SparkSession, config: LakeConfig) -> dict[dt.date, tuple[int, int]]:
    """(files, bytes) of each ingest date's folders; one entry per date."""
    column = "bronze_ingested_date"
    found: dict[dt.date, tuple[int, int]] = {}
    if partition_columns(config.bronze_partitions)[:1] != [column]:
        return found

    def add(folder: str, files: int, size: int) -> None:
        try:
            date = dt.date.fromisoformat(folder.removeprefix(f"{column}="))
        except ValueError:
            return  # another folder, or the null date, which is always read
        before = found.get(date, (0, 0))
        found[date] = (before[0] + files, before[1] + size)

    for root in (config.path("bronze"), config.path("bronze", BRONZE_BATCH), config.path("bronze", BRONZE_STREAM)):
        if has_sink_log(spark, root):
            # The files that the scan would list: those of committed batches.
            for path in read_layer(spark, root, config.format_of("bronze"), BRONZE_SCHEMA).inputFiles():
                add(next((part for part in path.split("/") if part.startswith(f"{column}=")), ""), 1, 0)
            continue
        for name in child_folders(spark, root):
            add(name, *folder_size(spark, f"{root}/{name}"))
    return found


def _window_records(spark: SparkSession, config: LakeConfig, landed: dict[dt.date, tuple[int, int]]) -> list[Row]:
    """The records that still hold; a row per ingest date."""
    path = config.path("bronze_windows")
    if not landed or not has_data_files(spark, path):
        return []
    rows = spark.read.schema(WINDOW_RECORD).parquet(path).collect()
    return [r for r in rows if landed.get(r.bronze_ingested_date) == (r.files, r.bytes)]


def _dates_to_skip(
    spark: SparkSession, records: list[Row], first: Column | None, last: Column | None
) -> list[dt.date]:
    """Recorded ingest dates without any row in the window."""
    outside = F.lit(False)
    if first is not None:
        outside = outside | (F.col("last_date") < first)
    if last is not None:
        outside = outside | (F.col("first_date") > last)
    return [r[0] for r in spark.createDataFrame(records, WINDOW_RECORD).where(outside).collect()]


def _record_windows(
    spark: SparkSession,
    config: LakeConfig,
    prepared: DataFrame,
    landed: dict[dt.date, tuple[int, int]],
    held: list[Row],
) -> None:
    """Record the window dates of ``prepared``'s ingest dates (folders), next
    to the records that hold."""
    window_date = F.col("processing_window_date")
    rows = (
        prepared.groupBy(FOLDER_DATE)
        .agg(F.min(window_date).alias("first_date"), F.max(window_date).alias("last_date"))
        .collect()
    )
    held_dates = {r.bronze_ingested_date for r in held}
    new = [
        (r[0], *landed[r[0]], r.first_date, r.last_date) for r in rows if r[0] in landed and r[0] not in held_dates
    ]
    table = spark.createDataFrame([*map(tuple, held), *new], WINDOW_RECORD)
    table.coalesce(1).write.mode("overwrite").parquet(config.path("bronze_windows"))


@contextmanager
def _silver_outside(
    spark: SparkSession, config: LakeConfig, window: Callable[[DataFrame], DataFrame]
) -> Iterator[DataFrame | None]:
    """``meta_id`` of the stored Silver rows outside a processing window; a
    row's window date is its event date. They come from the key index, or from
    Silver itself where that has no date folders."""
    if not has_data_files(spark, config.path("silver")):
        yield None
        return
    if partition_columns(config.silver_partitions) == ["event_date"]:
        index = KeyIndex(spark, config.path("silver_keys"), config.path("silver"), config.format_of("silver"))
        inside = [name.removeprefix(DATE_FOLDER) for name in _stored_dates(spark, config, window)]
        with index.outside(inside) as keys:
            yield keys
        return
    stored = read_layer(spark, config.path("silver"), config.format_of("silver"))
    dated = stored.select("meta_id", F.col("event_date").alias("processing_window_date"))
    inside = window(dated.select("processing_window_date").distinct())
    yield dated.join(inside, "processing_window_date", "left_anti").select("meta_id")


def _stored_dates(
    spark: SparkSession, config: LakeConfig, window: Callable[[DataFrame], DataFrame]
) -> dict[str, frozenset[str]]:
    """Silver's date folders inside the window, with the files of each."""
    if partition_columns(config.silver_partitions) != ["event_date"]:
        return {}
    folders = [n for n in child_folders(spark, config.path("silver")) if n.startswith("event_date=")]
    names = spark.createDataFrame([(n,) for n in folders], "name string")
    date = F.col("name").substr(F.lit(len("event_date=") + 1), F.length("name")).try_cast("date")
    inside = window(names.withColumn("processing_window_date", date)).collect()  # a row per stored date
    return {r.name: file_names(spark, f"{config.path('silver')}/{r.name}") for r in inside}


def run_bronze_to_silver(
    spark: SparkSession,
    config: LakeConfig,
    late_arrival_days: int = DEFAULT_LATE_ARRIVAL_DAYS,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    lookback_days: int | None = None,
    strict: bool = False,
    as_of: dt.datetime | None = None,
) -> SilverRun:
    """Bronze -> parsed -> classified -> window -> Silver + quarantine.

    A windowed run scans the ingest dates that can hold rows of its window:
    each run records the window dates of the ingest dates that it finds new
    or changed, and a date without a record that holds is always read.

    The classified frame is persisted, so Bronze is scanned and parsed once
    for both outputs (a lost executor only recomputes its blocks); the raw
    message stays in it for rejected rows only. In a full run only rows whose
    ``meta_id`` repeats are sorted and sent to be deduplicated.

    Silver holds one row per ``meta_id`` after any order of runs. A full run
    replaces Silver: of the copies of a ``meta_id`` the lowest (topic,
    partition, offset) survives. A windowed run replaces the dates of its
    window: a stored row outside the window keeps its ``meta_id`` and wins
    over the window's copies, and the lowest key survives among those.

    The quarantine count comes from an observation on the quarantine write,
    not from an extra job; the strict gate fires after both writes.
    """
    landed = _landed_dates(spark, config)
    records = _window_records(spark, config, landed)
    bronze = read_bronze(spark, config.path("bronze"), config.format_of("bronze"))

    def prepare(frame: DataFrame) -> DataFrame:
        # The folder's date, whatever zone the session has now.
        dated = frame.withColumn(FOLDER_DATE, F.col("bronze_ingested_date"))
        return prepare_for_quality_checks(parse_raw_messages(dated, keep=[FOLDER_DATE]), late_arrival_days, as_of)

    def window(df: DataFrame) -> DataFrame:
        return apply_processing_window(df, start, end, lookback_days, as_of)

    windowed_run = start is not None or end is not None or lookback_days is not None
    prepared = prepare(
        bronze_in_window(spark, bronze, records, *window_bounds(start, end, lookback_days, as_of))
    )
    rejected = F.col("quality_error_category").isNotNull()
    windowed = window(prepared).withColumn("raw_message", F.when(rejected, F.col("raw_message")))
    windowed = windowed.persist(StorageLevel.MEMORY_AND_DISK)
    overwrite = "dynamic" if windowed_run else "static"
    try:
        valid, quarantine = split_valid_and_quarantine(windowed)
        before = _stored_dates(spark, config, window) if windowed_run else {}
        observation = Observation("quarantine")
        rows = [F.count(F.lit(1)).alias("rows")]
        with (
            _silver_outside(spark, config, window) if windowed_run else nullcontext() as outside,
            nullcontext(keep_one_per_key) if windowed_run else one_per_repeated_key(valid, "meta_id") as one_per_key,
        ):
            if outside is not None:
                valid = valid.join(outside, "meta_id", "left_anti")
            silver = transform_to_silver(valid, one_per_key)
            paths = run_concurrently(
                {
                    "silver": lambda: config.writer("silver", overwrite_partitions=overwrite).write(silver),
                    "quarantine": lambda: config.writer("quarantine", overwrite_partitions=overwrite).write(
                        select_quarantine_columns(quarantine), observe=(observation, rows)
                    ),
                }
            )
        # A dynamic overwrite leaves dates that this run has no row for, with
        # rows whose survivor has moved to another date: they keep their files.
        after = _stored_dates(spark, config, window) if before else {}
        for name in before:
            if after.get(name) == before[name]:
                delete_folder(spark, f"{config.path('silver')}/{name}")
        open_dates = sorted(landed.keys() - {r.bronze_ingested_date for r in records})
        if open_dates:
            opened = bronze.where(F.col("bronze_ingested_date").isin(open_dates))
            _record_windows(spark, config, prepare(opened) if windowed_run else windowed, landed, records)
        # A write without any partition reports no metrics: no row was rejected.
        quarantined = int(observation.get.get("rows", 0))
    finally:
        windowed.unpersist()
    enforce_strict_quality(quarantined, strict)
    return SilverRun(paths["silver"], paths["quarantine"], quarantined)


# --- W3 ----------------------------------------------------------------------

def run_silver_to_gold(spark: SparkSession, config: LakeConfig) -> dict[str, str]:
    """Silver -> 5 dimensions + fact -> 8 serving tables.

    Gold is a full rebuild, so every table is written with static overwrite
    (a dynamic overwrite would leave old snapshot dates behind). Each model
    table reads the columns it needs from stored Silver; the serving tables
    are then built from the written fact and dimensions, which cuts the
    lineage and avoids recomputing the model for each of them.
    """
    silver = read_layer(spark, config.path("silver"), config.format_of("silver"))
    gold = config.writer("gold")
    # The fact has Silver's rows: where both lie by date, its tasks read the
    # dates that they write.
    fact, date = "fact_recent_changes", ["event_date"]
    by_date = all(
        partition_columns(p) == date for p in (config.silver_partitions, config.gold_partitions.get(fact))
    )
    with one_per_repeated_key(silver, "meta_id", by=date if by_date else ()) as one_per_key:
        model = build_model(silver, one_per_key)
        paths = write_tables(gold, model, config.gold_partitions, dealt={fact} if by_date else ())
    written = read_gold_tables(spark, config, model)
    aggregates = build_serving_tables(written, materialize=cut_lineage)  # a top-k of 100 rows
    paths.update(write_tables(gold, aggregates, config.gold_partitions))
    return paths


# --- W5 / Q17 -------------------------------------------------------------------

def read_gold_tables(spark: SparkSession, config: LakeConfig, names=GOLD_TABLES) -> dict[str, DataFrame]:
    return {n: read_gold_table(spark, config.path("gold"), n, config.format_of("gold")) for n in names}


def lake_metrics(spark: SparkSession, config: LakeConfig, skip_bronze: bool = False) -> DataFrame:
    """All layer metrics as one lazy frame ``(check, metric, value, failed)``."""
    frames = []
    if not skip_bronze:
        frames.append(bronze_metrics(read_bronze(spark, config.path("bronze"), config.format_of("bronze"))))
    frames.append(silver_metrics(read_layer(spark, config.path("silver"), config.format_of("silver"))))
    quarantine_path = config.path("quarantine")
    quarantine = (
        read_layer(spark, quarantine_path, config.format_of("quarantine"))
        if has_data_files(spark, quarantine_path)
        else None
    )
    frames.append(quarantine_metrics(quarantine, spark))
    frames.append(gold_metrics(read_gold_tables(spark, config)))
    return metrics_report(*frames)


def run_checks(
    spark: SparkSession,
    config: LakeConfig,
    skip_bronze: bool = False,
    raise_on_failure: bool = True,
) -> list[tuple]:
    """Bronze (optional), Silver, quarantine and Gold checks; one report.

    Returns every metric row; raises once, listing all failures, unless
    ``raise_on_failure`` is false."""
    report = lake_metrics(spark, config, skip_bronze)
    if raise_on_failure:
        return raise_on_failures(report)
    return [tuple(r) for r in report.collect()]  # one row per metric


def run_dashboard_check(spark: SparkSession, config: LakeConfig, min_fact_rows: int = 1) -> list[tuple]:
    """Q17 over the eight serving tables."""
    tables = read_gold_tables(spark, config, DASHBOARD_TABLES)
    return raise_on_failures(dashboard_readiness(tables, min_fact_rows))


# --- W6 ----------------------------------------------------------------------

def run_scheduled(
    spark: SparkSession,
    config: LakeConfig,
    late_arrival_days: int = DEFAULT_LATE_ARRIVAL_DAYS,
    lookback_days: int | None = None,
    strict: bool = False,
    min_fact_rows: int = 1,
    as_of: dt.datetime | None = None,
    raise_on_failure: bool = True,
) -> dict:
    """The scheduled order: Silver, Gold, checks without Bronze, dashboard check."""
    silver = run_bronze_to_silver(
        spark, config, late_arrival_days, lookback_days=lookback_days, strict=strict, as_of=as_of
    )
    gold = run_silver_to_gold(spark, config)
    checks = run_checks(spark, config, skip_bronze=True, raise_on_failure=raise_on_failure)
    dashboard = run_dashboard_check(spark, config, min_fact_rows)
    return {"silver": silver, "gold": gold, "checks": checks, "dashboard": dashboard}
