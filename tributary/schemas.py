"""Explicit schemas and column lists for every layer.

The payload schema and the layer column lists are fixed values: the
parsed table, the quarantine table and the Gold tables must carry
exactly these names for downstream readers and checks.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: payload schema, layer column lists, names and defaults ----
SOURCE_SYSTEM = "wikimedia_recent_changes"
QUALITY_RULE_VERSION = "wikimedia_recent_change_v1"
NULL_KEY_TOKEN = "__null__"
KEY_SEPARATOR = "||"
UNKNOWN_LABEL = "unknown"
DEFAULT_LATE_ARRIVAL_DAYS = 2
WINDOW_DURATION = "15 minutes"
SNAPSHOT_ROWS = 100
DEFAULT_STALE_AFTER_MINUTES = 30
DEFAULT_MAX_TOP_N = 30
DEFAULT_TOP_N = 10
DEFAULT_RECENT_ROWS = 25
DEFAULT_MAX_RECENT_ROWS = 100
DEFAULT_TRIGGER_INTERVAL = "30 seconds"

# JSON payload of one change event (top level + nested ``meta``).
EVENT_SCHEMA = StructType(
    [
        StructField("id", LongType()),
        StructField("type", StringType()),
        StructField("namespace", LongType()),
        StructField("title", StringType()),
        StructField("title_url", StringType()),
        StructField("comment", StringType()),
        StructField("parsedcomment", StringType()),
        StructField("timestamp", LongType()),
        StructField("user", StringType()),
        StructField("bot", BooleanType()),
        StructField("minor", BooleanType()),
        StructField("patrolled", BooleanType()),
        StructField("server_name", StringType()),
        StructField("wiki", StringType()),
        StructField(
            "meta",
            StructType(
                [
                    StructField("id", StringType()),
                    StructField("domain", StringType()),
                    StructField("stream", StringType()),
                    StructField("dt", StringType()),
                ]
            ),
        ),
    ]
)

# Columns of a Kafka record as the Spark Kafka source exposes them (the
# subset the pipeline consumes).
KAFKA_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

BRONZE_SCHEMA = StructType(
    [
        StructField("kafka_topic", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("kafka_timestamp", TimestampType()),
        StructField("message_key", StringType()),
        StructField("raw_message", StringType()),
        StructField("bronze_ingested_at", TimestampType()),
        StructField("source_system", StringType()),
        StructField("bronze_ingested_date", DateType()),
    ]
)

BRONZE_KEY = ("kafka_topic", "kafka_partition", "kafka_offset")

# Envelope columns carried from Bronze into the parsed table, in order.
ENVELOPE_COLUMNS = (
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "message_key",
    "raw_message",
    "bronze_ingested_at",
    "source_system",
)

# Parsed output name -> path inside the payload struct, in output order.
PARSED_FIELDS = (
    ("meta_id", "meta.id"),
    ("domain", "meta.domain"),
    ("stream_name", "meta.stream"),
    ("event_datetime", "meta.dt"),
    ("event_id", "id"),
    ("event_unix_timestamp", "timestamp"),
    ("event_type", "type"),
    ("namespace", "namespace"),
    ("page_title", "title"),
    ("page_url", "title_url"),
    ("event_user", "user"),
    ("is_bot", "bot"),
    ("server_name", "server_name"),
    ("wiki", "wiki"),
    ("comment", "comment"),
    ("parsed_comment", "parsedcomment"),
    ("is_minor", "minor"),
    ("is_patrolled", "patrolled"),
)

LOADED_COLUMNS = ENVELOPE_COLUMNS + tuple(name for name, _ in PARSED_FIELDS)

# Required business fields, in the order they are reported.
REQUIRED_FIELDS = (
    "meta_id",
    "event_id",
    "event_type",
    "wiki",
    "namespace",
    "page_title",
)
# Required fields that also count as missing when blank after trim.
REQUIRED_TEXT_FIELDS = frozenset({"meta_id", "event_type", "wiki", "page_title"})

# Error categories, in the order they are tested, with their fixed reasons.
CATEGORY_RAW_MISSING = "raw_message_missing"
CATEGORY_PARSE_FAILED = "schema_parse_failed"
CATEGORY_MISSING_FIELD = "missing_required_field"
CATEGORY_BAD_TIMESTAMP = "invalid_event_timestamp"
REASON_RAW_MISSING = "Raw Kafka message is null or blank."
REASON_PARSE_FAILED = "Raw message did not parse into the expected Wikimedia schema."
REASON_MISSING_FIELD = "One or more required business fields are missing."
REASON_BAD_TIMESTAMP = "Event timestamp could not be parsed from meta.dt or timestamp."

QUALITY_COLUMNS = (
    "arrival_lag_days",
    "is_late_arriving",
    "processing_window_date",
    "quality_checked_at",
    "quality_rule_version",
)

SILVER_COLUMNS = (
    "event_id",
    "meta_id",
    "event_type",
    "event_datetime",
    "event_date",
    "wiki",
    "domain",
    "stream_name",
    "namespace",
    "page_title",
    "page_url",
    "event_user",
    "is_bot",
    "is_minor",
    "is_patrolled",
    "server_name",
    "comment",
    "bronze_ingested_at",
    "source_system",
    "message_key",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
)

QUARANTINE_COLUMNS = (
    "quality_error_category",
    "quality_error_reason",
    "quality_checked_at",
    "quality_checked_date",
    "quality_rule_version",
    "missing_required_fields",
    "raw_message",
    "source_system",
    "message_key",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "bronze_ingested_at",
    "bronze_ingested_date",
    "processing_window_date",
    "meta_id",
    "event_id",
    "event_type",
    "event_datetime",
    "event_unix_timestamp",
    "parsed_event_datetime",
    "event_date",
    "wiki",
    "domain",
    "namespace",
    "page_title",
    "event_user",
)

FACT_COLUMNS = (
    "recent_change_key",
    "meta_id",
    "event_id",
    "date_key",
    "wiki_key",
    "page_key",
    "user_key",
    "event_type_key",
    "event_datetime",
    "event_date",
    "event_hour",
    "namespace",
    "is_bot",
    "is_minor",
    "is_patrolled",
    "comment",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "bronze_ingested_at",
)

SNAPSHOT_COLUMNS = (
    "event_datetime",
    "event_date",
    "event_type",
    "wiki",
    "page_title",
    "event_user",
    "is_bot",
    "namespace",
    "comment",
)

# Gold tables and their default partition columns ("" = unpartitioned).
GOLD_PARTITIONS = {
    "dim_date": "",
    "dim_wiki": "",
    "dim_page": "",
    "dim_user": "",
    "dim_event_type": "",
    "fact_recent_changes": "event_date",
    "agg_dashboard_kpis": "",
    "agg_events_by_date": "event_date",
    "agg_events_by_window": "event_date",
    "agg_events_by_type": "",
    "agg_events_by_wiki": "",
    "agg_top_users": "",
    "agg_top_pages": "",
    "recent_events_snapshot": "event_date",
}
GOLD_TABLES = tuple(GOLD_PARTITIONS)

BRONZE_PARTITIONS = "bronze_ingested_date,kafka_topic"
SILVER_PARTITIONS = "event_date"
QUARANTINE_PARTITIONS = "processing_window_date,quality_error_category"

# Column sets the dashboard needs from each serving table.
DASHBOARD_REQUIRED_COLUMNS = {
    "agg_dashboard_kpis": {"events", "bot_events", "unique_users", "unique_pages"},
    "agg_events_by_date": {"event_date", "events"},
    "agg_events_by_window": {
        "window_start",
        "window_end",
        "event_date",
        "event_hour",
        "events",
    },
    "agg_events_by_type": {"event_type", "events"},
    "agg_events_by_wiki": {"wiki", "events"},
    "agg_top_users": {"event_user", "is_bot", "events"},
    "agg_top_pages": {"page_title", "namespace", "events"},
    "recent_events_snapshot": {
        "event_datetime",
        "event_type",
        "wiki",
        "page_title",
        "event_user",
        "is_bot",
        "namespace",
        "comment",
    },
}
DASHBOARD_TABLES = tuple(DASHBOARD_REQUIRED_COLUMNS)

# Recent-event columns the dashboard shows, in display order.
VISIBLE_RECENT_COLUMNS = (
    "event_datetime",
    "event_type",
    "wiki",
    "page_title",
    "event_user",
    "is_bot",
    "namespace",
    "comment",
)
# --- end of the fixed values ------------------------------------------------
