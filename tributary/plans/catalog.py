"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

The change feed is derived from the driver's ``events`` table (all rows), run
through the same operators the jobs use, and cut at the operator under test.
Other queries run single operators over ``pages``, ``orders``, ``lineitem``
and the TPC-H dimensions. Timestamps leave as ``timestamp_ntz`` (UTC wall
clock) so results compare with engines that have no session zone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tributary.functions.text import blank_to_null, clean_text
from tributary.functions.time import calendar_parts, date_key
from tributary.functions.values import coerce_date, coerce_timestamp
from tributary.operators import aggregates as agg
from tributary.operators import checks, serving
from tributary.operators.gold import build_model, build_star_schema, serving_tables_of
from tributary.operators.dashboard_base import dashboard_base_of
from tributary.operators.quality import (
    QuarantineGateError,
    apply_processing_window,
    prepare_for_quality_checks,
    quarantine_counts,
    select_quarantine_columns,
    split_valid_and_quarantine,
)
from tributary.operators.silver import transform_to_silver
from tributary.operators.star import build_dashboard_base
from tributary.plans import jobs
from tributary.plans.check_state import lake_metrics_by_state
from tributary.plans.gold_refresh import refresh_gold
from tributary.plans.landing import Landing, land_new_offsets
from tributary.plans.publication import publish, publish_lake, published
from tributary.schemas import KAFKA_SCHEMA, UNKNOWN_LABEL
from tributary.session import checkpoint_dir, use_utc
from tributary.sinks.kafka import kafka_records, write_kafka
from tributary.sinks.lake import export_dashboard, preview_frame, schema_frame, write_layer
from tributary.sources.feed import FEED_PARTITIONS, FEED_TOPIC, change_feed, feed_events
from tributary.sources.kafka import (
    load_parsed_bronze,
    load_transformed,
    parse_raw_messages,
    raw_envelope,
    read_kafka,
    read_kafka_stream,
    to_bronze,
)
from tributary.sources.lake import lake_path, read_bronze, read_gold_table, read_layer

# --- fixed parameters of the registered queries -------------------------------
AS_OF = dt.datetime(2024, 3, 1, 0, 0, 0)
LATE_ARRIVAL_DAYS = 2
WINDOW_START = dt.date(2024, 1, 10)
WINDOW_END = dt.date(2024, 1, 20)
LOOKBACK_DAYS = 45
SERVING_START = dt.date(2024, 1, 25)
SERVING_END = dt.date(2024, 1, 30)
TOP_N = 10
MAX_TOP_N = 30
RECENT_ROWS = 25
MAX_RECENT_ROWS = 100
STALE_AFTER_MINUTES = 30
LONG_RUN = 100_000
FAR_SECONDS = 7_000_000_000_000
# ------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(df: DataFrame) -> DataFrame:
    """Session-zone timestamps -> ``timestamp_ntz`` (zone pinned to UTC)."""
    return df.select(
        *[
            F.col(f.name).cast(TimestampNTZType()).alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tasks(spark: SparkSession) -> int:
    """Parts for work that its input's files don't divide enough."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return to_bronze(change_feed(_table(spark, sf_dir, "events")), ingested_at=F.col("ingested_at"))


def _prepared(spark, sf_dir) -> DataFrame:
    loaded = parse_raw_messages(_bronze(spark, sf_dir))
    return prepare_for_quality_checks(loaded, LATE_ARRIVAL_DAYS, AS_OF)


def _silver(spark, sf_dir) -> DataFrame:
    valid, _ = split_valid_and_quarantine(_prepared(spark, sf_dir))
    return transform_to_silver(valid)


def _model(spark, sf_dir) -> dict[str, DataFrame]:
    return build_model(_silver(spark, sf_dir))


def _serving_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The eight serving tables, lazily: a query runs only those it reads."""
    return serving_tables_of(_silver(spark, sf_dir))


def _serving_data(spark, sf_dir, tables: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    tables = _serving_tables(spark, sf_dir) if tables is None else tables
    return serving.load_dashboard_data(tables, MAX_TOP_N, MAX_RECENT_ROWS)


# --- Bronze, parse, quality ----------------------------------------------------

def q_bronze(spark, sf_dir):
    """Raw envelope with the ingest date."""
    return _ntz(_bronze(spark, sf_dir))


def q_loaded(spark, sf_dir):
    """Payload parsed by the fixed schema, 26 columns."""
    return _ntz(parse_raw_messages(_bronze(spark, sf_dir)))


def q_quality_prepared(spark, sf_dir):
    """Every derived quality column."""
    return _ntz(_prepared(spark, sf_dir).drop("raw_message"))


def q_quality_category_counts(spark, sf_dir):
    """Rows per error category (null = valid)."""
    return quarantine_counts(_prepared(spark, sf_dir))


def q_quarantine(spark, sf_dir):
    """The quarantine projection."""
    _, rejected = split_valid_and_quarantine(_prepared(spark, sf_dir))
    return _ntz(select_quarantine_columns(rejected))


def q_processing_window(spark, sf_dir):
    """Inclusive date bounds, then rows per date and category."""
    windowed = apply_processing_window(_prepared(spark, sf_dir), WINDOW_START, WINDOW_END)
    return windowed.groupBy("processing_window_date", "quality_error_category").agg(
        F.count("*").alias("rows")
    )


def q_processing_lookback(spark, sf_dir):
    """Look-back from the fixed clock when no bound is set."""
    windowed = apply_processing_window(
        _prepared(spark, sf_dir), lookback_days=LOOKBACK_DAYS, as_of=AS_OF
    )
    return windowed.groupBy("processing_window_date").agg(F.count("*").alias("rows"))


# --- Silver and Gold -------------------------------------------------------------

def q_silver(spark, sf_dir):
    """P1, D1, C5-C9, P2, P3."""
    return _ntz(_silver(spark, sf_dir))


def _gold_query(name: str) -> Query:
    def run(spark, sf_dir):
        tables = _serving_tables(spark, sf_dir) if name.startswith("agg_") else _model(spark, sf_dir)
        return _ntz(tables[name])

    run.__name__ = f"q_{name}"
    return run


def q_recent_events_snapshot(spark, sf_dir):
    """L1: latest 100 events with labels."""
    return _ntz(_serving_tables(spark, sf_dir)["recent_events_snapshot"])


# --- jobs and streams over a scratch lake in the shared checkpoint folder ----------

def _scratch_lake(spark) -> jobs.LakeConfig:
    """A fresh lake folder under ``spark.checkpoint.dir`` (shared storage).

    The queries below are jobs: they write the lake when they are called and
    return a frame over its files, which are needed until that frame has been
    read. Nothing reads a ``lake-<uuid>`` folder later, so it can be deleted
    with the other files of the checkpoint folder after the application.
    """
    return jobs.LakeConfig(base_uri=f"{_shared_root(spark)}/lake-{uuid.uuid4().hex}")


def _shared_root(spark) -> str:
    root = checkpoint_dir(spark).rstrip("/")
    return root if "://" in root or root.startswith("file:") else f"file:{root}"


def _land(spark, sf_dir, config, events=None, **kwargs) -> None:
    feed = change_feed(_table(spark, sf_dir, "events") if events is None else events)
    jobs.run_kafka_to_bronze(spark, config, feed, ingested_at=F.col("ingested_at"), **kwargs)


def _landed_lake(spark, sf_dir) -> jobs.LakeConfig:
    use_utc(spark)
    config = _scratch_lake(spark)
    _land(spark, sf_dir, config)
    return config


def _gold_lake(spark, sf_dir) -> tuple[jobs.LakeConfig, dict[str, DataFrame]]:
    """A lake with all layers, and its 14 Gold tables."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    jobs.run_silver_to_gold(spark, config)
    return config, jobs.read_gold_tables(spark, config)


#: Events of one date that land late in the refresh queries; none of them shares
#: its meta_id with another event.
REFRESH_DATE = dt.date(2024, 1, 12)
_LANDS_LATE = f"to_date(ts) = date'{REFRESH_DATE}' and event_id % 100 between 20 and 60"


def _refreshed_lake(spark, sf_dir, between=None) -> tuple[jobs.LakeConfig, dict[str, DataFrame]]:
    """A lake whose Gold was built without some events of one date, which then
    land, change that date of Silver, and come into Gold by a refresh."""
    use_utc(spark)
    config, events = _scratch_lake(spark), _table(spark, sf_dir, "events")
    _land(spark, sf_dir, config, events.where(f"not ({_LANDS_LATE})"))
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    refresh_gold(spark, config)
    if between is not None:
        between(config)
    _land(spark, sf_dir, config, events.where(_LANDS_LATE))
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, REFRESH_DATE, REFRESH_DATE, as_of=AS_OF)
    refresh_gold(spark, config)
    return config, jobs.read_gold_tables(spark, config)


def _refresh_query(name: str) -> Query:
    def run(spark, sf_dir):
        return _ntz(_refreshed_lake(spark, sf_dir)[1][name])

    run.__doc__ = f"W3, K6: {name} after a refresh that reads one changed date of Silver."
    return run


def q_gold_refresh_rows(spark, sf_dir):
    """Rows of the 14 refreshed tables."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name, df in _refreshed_lake(spark, sf_dir)[1].items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _kafka_files(spark, events: DataFrame, source: str, mode: str = "errorifexists") -> None:
    change_feed(events).drop("ingested_at").write.mode(mode).parquet(source)


def _stream_into(spark, config, source: str) -> None:
    """Run the streaming Bronze job over Kafka-layout files until it is idle."""
    stream = read_kafka_stream(
        spark, "unused:9092", FEED_TOPIC, options={"path": source}, source_format="parquet", schema=KAFKA_SCHEMA
    )
    jobs.start_kafka_to_bronze_stream(spark, config, stream, available_now=True).awaitTermination()


def _without_clock(bronze: DataFrame) -> DataFrame:
    # The stream stamps its own ingest time.
    return _ntz(bronze.drop("bronze_ingested_at", "bronze_ingested_date"))


def q_dashboard_base(spark, sf_dir):
    """Stored fact left-joined to four stored dimensions with label fallbacks."""
    _, m = _gold_lake(spark, sf_dir)
    return _ntz(
        build_dashboard_base(
            m["fact_recent_changes"], m["dim_wiki"], m["dim_page"], m["dim_user"], m["dim_event_type"]
        )
    )


def q_dashboard_base_of_silver(spark, sf_dir):
    """J1-J5 straight from stored Silver: no exchange of the events."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    return _ntz(dashboard_base_of(read_layer(spark, config.path("silver"))))


class _Stopped(Exception):
    pass


def _stopped_lake(spark, sf_dir) -> jobs.LakeConfig:
    """A published lake after a run that wrote Silver and Gold of one date only
    and stopped before the switch."""
    config = _landed_lake(spark, sf_dir)
    publish_lake(spark, config, late_arrival_days=LATE_ARRIVAL_DAYS, as_of=AS_OF)

    def stopping(fresh: jobs.LakeConfig) -> None:
        jobs.run_bronze_to_silver(spark, fresh, LATE_ARRIVAL_DAYS, REFRESH_DATE, REFRESH_DATE, as_of=AS_OF)
        jobs.run_silver_to_gold(spark, fresh)
        raise _Stopped

    try:
        publish(spark, config, stopping)
    except _Stopped:
        return published(spark, config)
    raise RuntimeError("the run did not stop")


def q_published_after_stop(spark, sf_dir):
    """K4-K6: the fact that readers see after a run stopped before its switch."""
    return _ntz(read_gold_table(spark, _stopped_lake(spark, sf_dir).path("gold"), "fact_recent_changes"))


def q_published_switch(spark, sf_dir):
    """K4-K6: KPIs after a second published run over events that landed since."""
    use_utc(spark)
    config, events = _scratch_lake(spark), _table(spark, sf_dir, "events")
    _land(spark, sf_dir, config, events.where(f"not ({_LANDS_LATE})"))
    publish_lake(spark, config, late_arrival_days=LATE_ARRIVAL_DAYS, as_of=AS_OF)
    _land(spark, sf_dir, config, events.where(_LANDS_LATE))
    lake = publish_lake(spark, config, late_arrival_days=LATE_ARRIVAL_DAYS, as_of=AS_OF)
    return _ntz(read_gold_table(spark, lake.path("gold"), "agg_dashboard_kpis"))


def q_stream_bronze(spark, sf_dir):
    """The feed as Kafka-layout files, landed by the streaming
    Bronze job (available-now trigger, checkpointed offsets), read back."""
    use_utc(spark)
    config = _scratch_lake(spark)
    source = lake_path(config.base_uri, "kafka_files")
    _kafka_files(spark, _table(spark, sf_dir, "events"), source)
    _stream_into(spark, config, source)
    return _without_clock(read_bronze(spark, config.path("bronze")))


def q_stream_restart(spark, sf_dir):
    """Half of the feed, a restart without new files, then the rest;
    the checkpointed offsets land every record once."""
    use_utc(spark)
    config = _scratch_lake(spark)
    source, events = lake_path(config.base_uri, "kafka_files"), _table(spark, sf_dir, "events")
    _kafka_files(spark, events.where("event_id % 2 = 0"), source)
    _stream_into(spark, config, source)
    _stream_into(spark, config, source)
    _kafka_files(spark, events.where("event_id % 2 = 1"), source, mode="append")
    _stream_into(spark, config, source)
    return _without_clock(read_bronze(spark, config.path("bronze")))


def _mixed_landing(stream_first: bool) -> Query:
    def run(spark, sf_dir):
        use_utc(spark)
        config = _scratch_lake(spark)
        source, events = lake_path(config.base_uri, "kafka_files"), _table(spark, sf_dir, "events")
        _kafka_files(spark, events.where("event_id % 2 = 1"), source)
        steps = [
            lambda: _land(spark, sf_dir, config, events.where("event_id % 2 = 0")),
            lambda: _stream_into(spark, config, source),
        ]
        for step in reversed(steps) if stream_first else steps:
            step()
        _land(spark, sf_dir, config, only_new_offsets=True)  # the whole feed again
        return _without_clock(read_bronze(spark, config.path("bronze")))

    run.__doc__ = "W4, K2, K3, S6: half by batch, half by stream, then the batch rerun with only new offsets."
    return run


def q_batch_new_offsets(spark, sf_dir):
    """A batch that brings old and new offsets lands the new ones only."""
    use_utc(spark)
    config = _scratch_lake(spark)
    _land(spark, sf_dir, config, _table(spark, sf_dir, "events").where("event_id % 3 = 0"))
    _land(spark, sf_dir, config, only_new_offsets=True)
    return _ntz(read_bronze(spark, config.path("bronze")))


def _ledger_lake(spark, sf_dir) -> tuple[jobs.LakeConfig, list[Landing]]:
    """A topic whose first half is landed by the ledger, then the rest, then
    nothing new; files in the Kafka layout stand for the topic."""
    use_utc(spark)
    config, events = _scratch_lake(spark), _table(spark, sf_dir, "events")
    source = lake_path(config.base_uri, "kafka_files")
    half = events.agg(F.floor(F.max("event_id") / 2)).first()[0]
    feed = change_feed(events)

    def read(starting: str, ending: str) -> DataFrame:
        return spark.read.schema(feed.schema).parquet(source)

    landings = []
    for part in (feed.where(f"offset <= {half // FEED_PARTITIONS}"), feed.where(f"offset > {half // FEED_PARTITIONS}"), None):
        if part is not None:
            part.write.mode("append").parquet(source)
        landings.append(land_new_offsets(spark, config, read, {FEED_TOPIC: FEED_PARTITIONS}, F.col("ingested_at")))
    return config, landings


def q_batch_offset_ledger(spark, sf_dir):
    """Three batches by the offset ledger land every record once."""
    return _ntz(read_bronze(spark, _ledger_lake(spark, sf_dir)[0].path("bronze")))


def q_offset_ledger_ranges(spark, sf_dir):
    """From which offset each batch read each partition (-2: the earliest)."""
    _, landings = _ledger_lake(spark, sf_dir)
    rows = [
        (batch, topic, int(number), first)
        for batch, landing in enumerate(landings)
        for topic, own in landing.starting.items()
        for number, first in own.items()
    ]
    return spark.createDataFrame(rows, "batch int, topic string, kafka_partition int, starting long")


def q_bronze_loose_files(spark, sf_dir):
    """A third of the feed in files right below the Bronze path, a third
    by batch, a third by stream, then the whole feed again with only new offsets."""
    use_utc(spark)
    config, events = _scratch_lake(spark), _table(spark, sf_dir, "events")
    loose = to_bronze(change_feed(events.where("event_id % 3 = 0")), ingested_at=F.col("ingested_at"))
    write_layer(loose, config.path("bronze"))
    _land(spark, sf_dir, config, events.where("event_id % 3 = 1"))
    source = lake_path(config.base_uri, "kafka_files")
    _kafka_files(spark, events.where("event_id % 3 = 2"), source)
    _stream_into(spark, config, source)
    _land(spark, sf_dir, config, only_new_offsets=True)
    return _without_clock(read_bronze(spark, config.path("bronze")))


def q_stream_trigger(spark, sf_dir):
    """A running stream with a processing-time trigger takes files as they come."""
    use_utc(spark)
    config, events = _scratch_lake(spark), _table(spark, sf_dir, "events")
    source = lake_path(config.base_uri, "kafka_files")
    _kafka_files(spark, events.where("event_id % 2 = 0"), source)
    stream = read_kafka_stream(
        spark, "unused:9092", FEED_TOPIC, options={"path": source}, source_format="parquet", schema=KAFKA_SCHEMA
    )
    running = jobs.start_kafka_to_bronze_stream(spark, config, stream, trigger_interval="1 second")
    try:
        running.processAllAvailable()
        _kafka_files(spark, events.where("event_id % 2 = 1"), source, mode="append")
        running.processAllAvailable()
    finally:
        running.stop()
    return _without_clock(read_bronze(spark, config.path("bronze")))


def q_kafka_write(spark, sf_dir):
    """K7: the records that ``write_kafka`` writes, in a file format, read back."""
    use_utc(spark)
    path = f"{_shared_root(spark)}/kafka-{uuid.uuid4().hex}"
    records = kafka_records(feed_events(_table(spark, sf_dir, "events")))
    write_kafka(records, "unused:9092", FEED_TOPIC, options={"path": path}, output_format="parquet")
    return spark.read.parquet(path)


def q_topic_schema(spark, sf_dir):
    """S3: columns of a topic's records, in order."""
    source = f"{_shared_root(spark)}/kafka-{uuid.uuid4().hex}"
    _kafka_files(spark, _table(spark, sf_dir, "events"), source)
    scan = read_kafka(
        spark, "unused:9092", FEED_TOPIC, options={"path": source}, source_format="parquet", schema=KAFKA_SCHEMA
    )
    return schema_frame(scan)


def q_layer_preview(spark, sf_dir):
    """The first rows of Silver by its key."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    return _ntz(preview_frame(read_layer(spark, config.path("silver")), TOP_N, by=("meta_id",)))


def q_kafka_scan(spark, sf_dir):
    """The bounded Kafka scan, over files in the Kafka layout."""
    use_utc(spark)
    source = f"{_shared_root(spark)}/kafka-{uuid.uuid4().hex}"
    _kafka_files(spark, _table(spark, sf_dir, "events"), source)
    scan = read_kafka(
        spark, "unused:9092", FEED_TOPIC, options={"path": source}, source_format="parquet", schema=KAFKA_SCHEMA
    )
    return _ntz(raw_envelope(scan).drop("bronze_ingested_at"))


def q_loaded_bronze(spark, sf_dir):
    """The composed loader over a landed Bronze folder."""
    return _ntz(load_parsed_bronze(spark, _landed_lake(spark, sf_dir).path("bronze")))


def q_loaded_transformed(spark, sf_dir):
    """Bronze folder to cleaned events, without the quality stage."""
    return _ntz(load_transformed(spark, _landed_lake(spark, sf_dir).path("bronze")))


def q_silver_window_rerun(spark, sf_dir):
    """A full run, then a rerun of a window of dates."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, WINDOW_START, WINDOW_END, as_of=AS_OF)
    return _ntz(read_layer(spark, config.path("silver")))


def q_quarantine_window_rerun(spark, sf_dir):
    """The same runs leave every rejected row in quarantine once."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, WINDOW_START, WINDOW_END, as_of=AS_OF)
    return _ntz(select_quarantine_columns(read_layer(spark, config.path("quarantine"))))


def q_silver_moved_survivor(spark, sf_dir):
    """A copy of a meta_id that lands later under a lower Kafka key
    takes over in the next full run, and the old row goes."""
    use_utc(spark)
    config, events = _scratch_lake(spark), _table(spark, sf_dir, "events")
    _land(spark, sf_dir, config, events.where("event_id % 100 != 10"))
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    _land(spark, sf_dir, config, events.where("event_id % 100 = 10"))
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    return _ntz(read_layer(spark, config.path("silver")))


def q_strict_gate(spark, sf_dir):
    """Q8: the strict gate fires after both layers are written."""
    config = _landed_lake(spark, sf_dir)
    try:
        jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, strict=True, as_of=AS_OF)
        fired = False
    except QuarantineGateError:
        fired = True
    rows = F.count(F.lit(1))
    silver = read_layer(spark, config.path("silver")).agg(rows.alias("silver_rows"))
    rejected = read_layer(spark, config.path("quarantine")).agg(rows.alias("quarantine_rows"))
    both = silver.unionByName(rejected, allowMissingColumns=True)
    return both.agg(
        F.lit(fired).alias("gate_fired"), F.max("silver_rows").alias("silver_rows"),
        F.max("quarantine_rows").alias("quarantine_rows"),
    )


def q_scheduled(spark, sf_dir):
    """The scheduled order over a landed lake; the by-date table it leaves."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_scheduled(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF, raise_on_failure=False)
    return _ntz(read_gold_table(spark, config.path("gold"), "agg_events_by_date"))


def q_star_schema_rows(spark, sf_dir):
    """Rows of the 14 tables of the composed model over stored Silver."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    tables = build_star_schema(read_layer(spark, config.path("silver")))
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _exports(spark, sf_dir) -> dict[str, str]:
    """The four CSV exports. Each is a job of its own, so Silver is stored
    first: the feed is parsed, deduplicated and cleaned once, not four times."""
    use_utc(spark)
    silver = write_layer(_silver(spark, sf_dir), _scratch_lake(spark).path("silver"))
    tables = serving_tables_of(read_layer(spark, silver))
    return export_dashboard(_views(spark, sf_dir, tables), f"{_shared_root(spark)}/exports-{uuid.uuid4().hex}")


def q_csv_exports(spark, sf_dir):
    """K9: the dashboard's four CSV exports, read back and counted."""
    paths = _exports(spark, sf_dir)
    frames = [
        spark.read.option("header", True).csv(path).agg(F.lit(name).alias("export"), F.count(F.lit(1)).alias("rows"))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def q_csv_top_pages(spark, sf_dir):
    """K9: the top pages export, read back with its types."""
    path = _exports(spark, sf_dir)["top_pages"]
    return spark.read.option("header", True).schema("page_title string, namespace long, events long").csv(path)


def q_dynamic_overwrite(spark, sf_dir):
    """All event types written, one overwritten dynamically."""
    path = f"{_shared_root(spark)}/overwrite-{uuid.uuid4().hex}"
    events = _table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    write_layer(events, path, mode="overwrite", partition_by="event_type")
    doubled = events.where("event_type = 'click'").withColumn("value", F.col("value") * 2)
    write_layer(doubled, path, mode="overwrite", partition_by="event_type", overwrite_partitions="dynamic")
    return spark.read.parquet(path)


def q_job_silver(spark, sf_dir):
    """Land Bronze, run Bronze -> Silver, read Silver back."""
    config = _landed_lake(spark, sf_dir)
    jobs.run_bronze_to_silver(spark, config, LATE_ARRIVAL_DAYS, as_of=AS_OF)
    return _ntz(read_layer(spark, config.path("silver")))


def q_job_gold_fact(spark, sf_dir):
    """Silver -> Gold job, the fact table read back."""
    _, tables = _gold_lake(spark, sf_dir)
    return _ntz(tables["fact_recent_changes"])


def q_job_checks(spark, sf_dir):
    """W5, Q11-Q15 over the written lake: land, Silver and Gold jobs, then the
    metrics of Bronze, Silver, quarantine and the 14 Gold tables."""
    config, _ = _gold_lake(spark, sf_dir)
    return jobs.lake_metrics(spark, config)


def q_checks_by_state(spark, sf_dir):
    """Q9, Q12-Q14 from the states of the dates: counted once before events of
    one date land late and once after, when that date alone is read."""
    config, _ = _refreshed_lake(spark, sf_dir, between=lambda c: lake_metrics_by_state(spark, c, skip_bronze=True))
    report, read = lake_metrics_by_state(spark, config, skip_bronze=True)
    if read["silver"] != [str(REFRESH_DATE)]:
        raise RuntimeError(f"Dates that had not changed were read: {read['silver']}.")
    return report


# --- Kafka publishing --------------------------------------------------------------

def q_kafka_publish(spark, sf_dir):
    """K7, K8: record key and JSON value for every change event."""
    use_utc(spark)
    events = feed_events(_table(spark, sf_dir, "events"))
    return kafka_records(events, keep=["event_id"])


# --- single operators over other driver tables ---------------------------------------

def q_clean_text_pages(spark, sf_dir):
    """clean_text and blank_to_null over whole page HTML."""
    pages = _table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        clean_text("html").alias("clean_html"),
        blank_to_null("url").alias("clean_url"),
        F.length(clean_text("html")).alias("clean_length"),
    )


def q_clean_text_long(spark, sf_dir):
    """Pages with long runs of blanks, tags and entities around them.

    The texts are some hundred times as long as the stored ones, so the pages
    are dealt to all cores before they grow, however few files hold them.
    """
    pages = _table(spark, sf_dir, "pages").repartition(_tasks(spark))
    run = {text: F.repeat(F.lit(text), LONG_RUN) for text in (" ", "<b>", "&nbsp;")}
    text = F.concat(run[" "], F.col("html"), run["<b>"], F.lit("middle"), run["&nbsp;"], F.lit("end"))
    return pages.select("page_id", clean_text(text).alias("clean_html"))


def q_far_event_times(spark, sf_dir):
    """Seconds that no int date key can hold are rejected, and the
    model is built from the other rows; events per date key."""
    bronze = _bronze(spark, sf_dir)
    far = F.regexp_replace("raw_message", r'"timestamp":\d+', f'"timestamp":{FAR_SECONDS}')
    moved = bronze.withColumn("raw_message", F.when(F.col("raw_message").contains('"dt":"bad"'), far).otherwise(F.col("raw_message")))
    prepared = prepare_for_quality_checks(parse_raw_messages(moved), LATE_ARRIVAL_DAYS, AS_OF)
    valid, rejected = split_valid_and_quarantine(prepared)
    fact = build_model(transform_to_silver(valid))["fact_recent_changes"]
    times = rejected.where("quality_error_category = 'invalid_event_timestamp'")
    count = F.count(F.lit(1)).alias("events")
    return fact.groupBy("date_key").agg(count).unionByName(
        times.groupBy(F.lit(None).cast("int").alias("date_key")).agg(count)
    )


def q_date_coercion(spark, sf_dir):
    """Order dates as text, some of them unreadable, to dates and times."""
    orders = _table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("no date")).when(
        F.col("o_orderkey") % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    rows = orders.select("o_orderkey", text.alias("t"))
    return rows.select("o_orderkey", coerce_date("t").alias("day"), coerce_timestamp("t").cast(TimestampNTZType()).alias("at"))


def q_dim_date_orders(spark, sf_dir):
    """Date dimension over order dates."""
    orders = _table(spark, sf_dir, "orders")
    dates = orders.select(F.to_date("o_orderdate").alias("event_date")).where(
        F.col("event_date").isNotNull()
    )
    return (
        dates.select(date_key("event_date").alias("date_key"), "event_date")
        .distinct()
        .withColumns(calendar_parts("event_date"))
    )


def q_duplicate_keys(spark, sf_dir):
    """Q9: key groups with more than one row, for three keys."""
    orders = _table(spark, sf_dir, "orders")
    events = _table(spark, sf_dir, "events")
    lineitem = _table(spark, sf_dir, "lineitem")
    frames = [
        checks.duplicate_key_groups(orders, ["o_custkey"]).select(
            F.lit("orders.o_custkey").alias("key"), "duplicate_groups"),
        checks.duplicate_key_groups(events, ["user_id", "event_type"]).select(
            F.lit("events.user_id,event_type").alias("key"), "duplicate_groups"),
        checks.duplicate_key_groups(lineitem, ["l_orderkey", "l_linenumber"]).select(
            F.lit("lineitem.l_orderkey,l_linenumber").alias("key"), "duplicate_groups"),
    ]
    return checks.metrics_report(*frames)


def q_null_counts_events(spark, sf_dir):
    """Q10: null count of every column in one aggregate."""
    return checks.null_counts(_table(spark, sf_dir, "events"))


def q_events_by_window_raw(spark, sf_dir):
    """A3, T5: 15-minute tumbling windows straight on ``events.ts``."""
    use_utc(spark)
    events = _table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("event_datetime"),
        F.to_date("ts").alias("event_date"),
        F.hour("ts").alias("event_hour"),
    )
    return _ntz(agg.agg_events_by_window(events))


def q_events_props_json(spark, sf_dir):
    """S12 on another payload: ``events.props`` parsed by a fixed schema."""
    events = _table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.from_json("props", "k long").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"))


def q_lineitem_star_labels(spark, sf_dir):
    """J1-J4 on the TPC-H star: line items left-joined to order, customer and
    nation labels (``unknown`` fallback), counted per label after per-key
    pre-aggregation."""
    lineitem = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("_lines"), F.sum("l_quantity").alias("_qty")
    )
    labelled = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey, "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.coalesce("n_name", F.lit(UNKNOWN_LABEL)).alias("nation"),
            F.coalesce("c_mktsegment", F.lit(UNKNOWN_LABEL)).alias("segment"),
            "_lines",
            "_qty",
        )
    )
    return labelled.groupBy("nation", "segment").agg(
        F.sum("_lines").alias("line_items"), F.round(F.sum("_qty"), 2).alias("quantity")
    )


# --- checks ---------------------------------------------------------------------------

def q_check_bronze(spark, sf_dir):
    """Q11."""
    return checks.bronze_metrics(_bronze(spark, sf_dir))


def q_check_silver(spark, sf_dir):
    """Q12."""
    return checks.silver_metrics(_silver(spark, sf_dir))


def q_check_quarantine(spark, sf_dir):
    """Q13."""
    _, rejected = split_valid_and_quarantine(_prepared(spark, sf_dir))
    return checks.quarantine_metrics(select_quarantine_columns(rejected))


def q_check_gold(spark, sf_dir):
    """Q14 over a written Gold layer."""
    return checks.gold_metrics(_gold_lake(spark, sf_dir)[1])


def q_dashboard_readiness(spark, sf_dir):
    """Q16, Q17 over a written Gold layer."""
    return checks.dashboard_readiness(_gold_lake(spark, sf_dir)[1], min_fact_rows=1)


# --- serving ----------------------------------------------------------------------------

def _views(spark, sf_dir, tables: dict[str, DataFrame] | None = None):
    return serving.dashboard_views(
        _serving_data(spark, sf_dir, tables), SERVING_START, SERVING_END, TOP_N, RECENT_ROWS,
        STALE_AFTER_MINUTES, AS_OF,
    )


def q_serving_metric_cards(spark, sf_dir):
    """V1, A9, C16, C17, V3."""
    return _views(spark, sf_dir)["metric_cards"]


def q_serving_readiness(spark, sf_dir):
    """V2, A11."""
    return _views(spark, sf_dir)["readiness"]


def q_serving_freshness(spark, sf_dir):
    """V3 with a fixed clock."""
    data = _serving_data(spark, sf_dir)
    return _ntz(serving.freshness_status(data["recent_events"], STALE_AFTER_MINUTES, AS_OF))


def q_serving_events_by_date(spark, sf_dir):
    """Date-filtered series for the chart."""
    return _views(spark, sf_dir)["events_by_date_chart"]


def q_serving_events_by_window(spark, sf_dir):
    """P9, L5 on the window table."""
    return _ntz(_views(spark, sf_dir)["events_by_window_chart"])


def q_serving_top_pages(spark, sf_dir):
    """Top pages capped at ``TOP_N``."""
    return _views(spark, sf_dir)["top_pages"]


def q_serving_top_users(spark, sf_dir):
    """Top users capped at ``TOP_N``."""
    return _views(spark, sf_dir)["top_users"]


def q_serving_event_types(spark, sf_dir):
    """Event type chart."""
    return _views(spark, sf_dir)["event_types_chart"]


def q_serving_wikis(spark, sf_dir):
    """Wiki chart."""
    return _views(spark, sf_dir)["wikis_chart"]


def q_serving_recent_events(spark, sf_dir):
    """P10: visible recent-event columns within the date range."""
    return _ntz(_views(spark, sf_dir)["recent_events"])


def q_serving_date_bounds(spark, sf_dir):
    """A10."""
    data = _serving_data(spark, sf_dir)
    return serving.date_bounds(data["events_by_date"], AS_OF)


def q_serving_selected_events(spark, sf_dir):
    """A9 over the date-filtered by-date table."""
    data = _serving_data(spark, sf_dir)
    by_date = serving.filter_by_date_range(
        data["events_by_date"], "event_date", SERVING_START, SERVING_END
    )
    return serving.selected_event_count(by_date)


GOLD_NAMES = (
    "dim_date",
    "dim_wiki",
    "dim_page",
    "dim_user",
    "dim_event_type",
    "fact_recent_changes",
    "agg_dashboard_kpis",
    "agg_events_by_date",
    "agg_events_by_window",
    "agg_events_by_type",
    "agg_events_by_wiki",
    "agg_top_users",
    "agg_top_pages",
)


def queries() -> dict[str, Query]:
    registry: dict[str, Query] = {
        "bronze": q_bronze,
        "loaded": q_loaded,
        "quality_prepared": q_quality_prepared,
        "quality_category_counts": q_quality_category_counts,
        "quarantine": q_quarantine,
        "processing_window": q_processing_window,
        "processing_lookback": q_processing_lookback,
        "silver": q_silver,
    }
    registry.update({name: _gold_query(name) for name in GOLD_NAMES})
    registry.update(
        {
            "recent_events_snapshot": q_recent_events_snapshot,
            "dashboard_base": q_dashboard_base,
            "dashboard_base_of_silver": q_dashboard_base_of_silver,
            "published_after_stop": q_published_after_stop,
            "published_switch": q_published_switch,
            "kafka_publish": q_kafka_publish,
            "stream_bronze": q_stream_bronze,
            "stream_restart": q_stream_restart,
            "bronze_batch_then_stream": _mixed_landing(stream_first=False),
            "bronze_stream_then_batch": _mixed_landing(stream_first=True),
            "batch_new_offsets": q_batch_new_offsets,
            "batch_offset_ledger": q_batch_offset_ledger,
            "offset_ledger_ranges": q_offset_ledger_ranges,
            "bronze_loose_files": q_bronze_loose_files,
            "stream_trigger": q_stream_trigger,
            "kafka_write": q_kafka_write,
            "topic_schema": q_topic_schema,
            "layer_preview": q_layer_preview,
            "kafka_scan": q_kafka_scan,
            "loaded_bronze": q_loaded_bronze,
            "loaded_transformed": q_loaded_transformed,
            "silver_window_rerun": q_silver_window_rerun,
            "quarantine_window_rerun": q_quarantine_window_rerun,
            "silver_moved_survivor": q_silver_moved_survivor,
            "strict_gate": q_strict_gate,
            "scheduled": q_scheduled,
            "star_schema_rows": q_star_schema_rows,
            "gold_refresh_kpis": _refresh_query("agg_dashboard_kpis"),
            "gold_refresh_top_pages": _refresh_query("agg_top_pages"),
            "gold_refresh_fact": _refresh_query("fact_recent_changes"),
            "gold_refresh_snapshot": _refresh_query("recent_events_snapshot"),
            "gold_refresh_rows": q_gold_refresh_rows,
            "csv_exports": q_csv_exports,
            "csv_top_pages": q_csv_top_pages,
            "dynamic_overwrite": q_dynamic_overwrite,
            "clean_text_long": q_clean_text_long,
            "far_event_times": q_far_event_times,
            "date_coercion": q_date_coercion,
            "job_silver": q_job_silver,
            "job_gold_fact": q_job_gold_fact,
            "job_checks": q_job_checks,
            "checks_by_state": q_checks_by_state,
            "clean_text_pages": q_clean_text_pages,
            "dim_date_orders": q_dim_date_orders,
            "duplicate_keys": q_duplicate_keys,
            "null_counts_events": q_null_counts_events,
            "events_by_window_raw": q_events_by_window_raw,
            "events_props_json": q_events_props_json,
            "lineitem_star_labels": q_lineitem_star_labels,
            "check_bronze": q_check_bronze,
            "check_silver": q_check_silver,
            "check_quarantine": q_check_quarantine,
            "check_gold": q_check_gold,
            "dashboard_readiness": q_dashboard_readiness,
            "serving_metric_cards": q_serving_metric_cards,
            "serving_readiness": q_serving_readiness,
            "serving_freshness": q_serving_freshness,
            "serving_events_by_date": q_serving_events_by_date,
            "serving_events_by_window": q_serving_events_by_window,
            "serving_top_pages": q_serving_top_pages,
            "serving_top_users": q_serving_top_users,
            "serving_event_types": q_serving_event_types,
            "serving_wikis": q_serving_wikis,
            "serving_recent_events": q_serving_recent_events,
            "serving_date_bounds": q_serving_date_bounds,
            "serving_selected_events": q_serving_selected_events,
        }
    )
    return registry
