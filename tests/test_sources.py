import pytest

from tributary.schemas import BRONZE_SCHEMA, LOADED_COLUMNS
from tributary.sinks.kafka import kafka_records
from tributary.sources.feed import feed_events
from tributary.sources.kafka import parse_raw_messages, to_bronze
from tributary.sources.lake import lake_path, partition_columns
from tests.conftest import SMALL_SF, kafka_frame, event


def test_lake_path_and_partitions():
    assert lake_path("abfss://c@a.dfs.core.windows.net/", "/bronze/x/", "t/") == \
        "abfss://c@a.dfs.core.windows.net/bronze/x/t"
    with pytest.raises(ValueError):
        lake_path("<your-account>", "x")
    assert partition_columns(" a, ,b ,") == ["a", "b"]
    assert partition_columns("") == []


def test_bronze_names_and_types(spark):
    bronze = to_bronze(kafka_frame(spark, [event()]))
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]
    # reference test expects these Bronze names (the payload column is raw_message)
    for name in ("kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
                 "bronze_ingested_date", "raw_message"):
        assert name in bronze.columns


def test_parse_layout(spark):
    loaded = parse_raw_messages(to_bronze(kafka_frame(spark, [event(), None])))
    assert tuple(loaded.columns) == LOADED_COLUMNS
    rows = loaded.orderBy("kafka_offset").collect()
    assert rows[0]["meta_id"] == "abc" and rows[0]["event_id"] == 1
    assert rows[1]["meta_id"] is None


def test_kafka_records_round_trip(spark):
    events = feed_events(spark.read.parquet(f"{SMALL_SF}/events.parquet")).where("d >= 4")
    records = kafka_records(events)
    assert records.columns == ["key", "value"]
    back = parse_raw_messages(
        records.selectExpr("'t' AS kafka_topic", "0 AS kafka_partition", "0L AS kafka_offset",
                           "CAST(NULL AS TIMESTAMP) AS kafka_timestamp", "key AS message_key",
                           "value AS raw_message", "CAST(NULL AS TIMESTAMP) AS bronze_ingested_at",
                           "'s' AS source_system")
    )
    assert back.where("event_id IS NULL").count() == 0
