"""Kafka scans, the raw Bronze envelope and the JSON parse.

The Kafka connector is not bundled; on a cluster add
``org.apache.spark:spark-sql-kafka-0-10_2.13`` to the job. Every reader takes
``source_format`` so the same code runs on files in the Kafka column layout.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.functions.time import clock
from tributary.schemas import (
    ENVELOPE_COLUMNS,
    EVENT_SCHEMA,
    KAFKA_SCHEMA,
    PARSED_FIELDS,
    SOURCE_SYSTEM,
)


def read_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
    options: Mapping[str, str] | None = None,
    source_format: str = "kafka",
    schema: StructType | None = None,
) -> DataFrame:
    """Bounded scan of one topic (S1); also the topic inspection scan (S3)."""
    reader = (
        spark.read.format(source_format)
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("endingOffsets", ending_offsets)
    )
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str | None = None,
    options: Mapping[str, str] | None = None,
    source_format: str = "kafka",
    schema: StructType | None = None,
) -> DataFrame:
    """Unbounded scan (S2); offsets are tracked by the sink's checkpoint. File
    formats need a ``schema`` (``KAFKA_SCHEMA``) and a ``path`` option."""
    reader = (
        spark.readStream.format(source_format)
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets or "earliest")
        .option("failOnDataLoss", "false")
    )
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def read_kafka_layout_files(spark: SparkSession, path: str, streaming: bool = False):
    """Files holding Kafka records (key, value, topic, partition, offset, timestamp)."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(KAFKA_SCHEMA).parquet(path)


def _ingest_time(ingested_at: Column | dt.datetime | None) -> Column:
    if isinstance(ingested_at, Column):
        return ingested_at.cast("timestamp")
    return clock(ingested_at)


def raw_envelope(
    kafka_df: DataFrame,
    ingested_at: Column | dt.datetime | None = None,
    source_system: str = SOURCE_SYSTEM,
) -> DataFrame:
    """Kafka record -> raw envelope (S4): renamed metadata, text key and value."""
    return kafka_df.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_message"),
        _ingest_time(ingested_at).alias("bronze_ingested_at"),
        F.lit(source_system).alias("source_system"),
    )


def to_bronze(
    kafka_df: DataFrame,
    ingested_at: Column | dt.datetime | None = None,
    source_system: str = SOURCE_SYSTEM,
) -> DataFrame:
    """Raw envelope plus the ingest date used to partition Bronze."""
    return raw_envelope(kafka_df, ingested_at, source_system).withColumn(
        "bronze_ingested_date", F.to_date("bronze_ingested_at")
    )


def parse_raw_messages(raw_df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``raw_message`` by the fixed payload schema and flatten.

    Parsing happens straight on the scan (no RDD round trip), so column
    pruning and partition filters still reach the Parquet reader. The parsed
    struct is emitted through ``inline`` (a Generate node): predicates on
    parsed fields cannot be pushed below it, so each message is parsed once
    instead of once more per field a later filter mentions. A null or
    malformed message gives one row of nulls, as in PERMISSIVE mode. Columns
    named in ``keep`` pass through beside the envelope.
    """
    event = F.from_json(F.col("raw_message"), EVENT_SCHEMA)
    parsed = raw_df.select(*ENVELOPE_COLUMNS, *keep, F.inline(F.array(event)))
    return parsed.select(
        *ENVELOPE_COLUMNS,
        *keep,
        *[F.col(path).alias(name) for name, path in PARSED_FIELDS],
    )


def load_from_kafka(kafka_df: DataFrame, ingested_at=None) -> DataFrame:
    """Kafka records -> parsed table (S13, debugging path)."""
    return parse_raw_messages(raw_envelope(kafka_df, ingested_at))


def load_parsed_bronze(spark: SparkSession, bronze_path: str, source_format: str = "parquet"):
    """Bronze folder -> parsed table."""
    from tributary.sources.lake import read_bronze

    return parse_raw_messages(read_bronze(spark, bronze_path, source_format))


def load_transformed(spark: SparkSession, bronze_path: str, source_format: str = "parquet"):
    """Bronze folder -> parsed -> Silver clean-up, without the quality stage."""
    from tributary.operators.silver import transform_to_silver

    return transform_to_silver(load_parsed_bronze(spark, bronze_path, source_format))
