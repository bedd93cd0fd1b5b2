"""Scans: Kafka (batch and stream), Bronze and other lake layers, the test feed."""

from tributary.sources.feed import change_feed
from tributary.sources.kafka import (
    load_from_kafka,
    load_parsed_bronze,
    load_transformed,
    parse_raw_messages,
    raw_envelope,
    read_kafka,
    read_kafka_layout_files,
    read_kafka_stream,
    to_bronze,
)
from tributary.sources.lake import (
    MissingDataError,
    has_data_files,
    lake_path,
    partition_columns,
    read_bronze,
    read_gold_table,
    read_layer,
)

__all__ = [
    "MissingDataError",
    "change_feed",
    "has_data_files",
    "lake_path",
    "load_from_kafka",
    "load_parsed_bronze",
    "load_transformed",
    "parse_raw_messages",
    "partition_columns",
    "raw_envelope",
    "read_bronze",
    "read_gold_table",
    "read_kafka",
    "read_kafka_layout_files",
    "read_kafka_stream",
    "read_layer",
    "to_bronze",
]
