import os

from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tributary.sources.feed import change_feed
from tributary.sources.kafka import read_kafka_layout_files
from tributary.sources.lake import read_bronze
from tributary.streaming import start_bronze_stream


def test_stream_restart_adds_nothing(spark, tmp_lake):
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet")).drop("ingested_at")
    source = os.path.join(tmp_lake, "source")
    feed.where("event_id % 2 = 0").write.parquet(source, mode="append")
    out, ckpt = os.path.join(tmp_lake, "bronze"), os.path.join(tmp_lake, "ckpt")

    def run():
        stream = read_kafka_layout_files(spark, source, streaming=True)
        q = start_bronze_stream(stream, out, ckpt, available_now=True)
        q.awaitTermination(300)
        return read_bronze(spark, out).count()

    first = run()
    assert first == feed.where("event_id % 2 = 0").count()
    assert run() == first  # restart from the checkpoint: nothing landed twice
    feed.where("event_id % 2 = 1").write.parquet(source, mode="append")
    assert run() == feed.count()
    bronze = read_bronze(spark, out)
    dupes = bronze.groupBy("kafka_topic", "kafka_partition", "kafka_offset").count().where(F.col("count") > 1)
    assert dupes.count() == 0


def test_processing_time_trigger_runs_until_stopped(spark, tmp_lake):
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet")).drop("ingested_at")
    source = os.path.join(tmp_lake, "source")
    feed.where("event_id % 2 = 0").write.parquet(source)
    stream = read_kafka_layout_files(spark, source, streaming=True)
    out = os.path.join(tmp_lake, "bronze")
    query = start_bronze_stream(stream, out, os.path.join(tmp_lake, "ckpt"), trigger_interval="200 milliseconds")
    try:
        query.processAllAvailable()
        assert read_bronze(spark, out).count() == feed.where("event_id % 2 = 0").count()
        feed.where("event_id % 2 = 1").write.parquet(source, mode="append")
        query.processAllAvailable()
        assert query.isActive and read_bronze(spark, out).count() == feed.count()
    finally:
        query.stop()


def test_default_trigger_is_processing_time(spark, tmp_lake):
    source = os.path.join(tmp_lake, "source")
    change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet")).drop("ingested_at").write.parquet(source)
    stream = read_kafka_layout_files(spark, source, streaming=True)
    out = os.path.join(tmp_lake, "bronze")
    query = start_bronze_stream(stream, out, os.path.join(tmp_lake, "ckpt"))
    try:
        query.processAllAvailable()
        assert query.isActive and read_bronze(spark, out).count() > 0
    finally:
        query.stop()
