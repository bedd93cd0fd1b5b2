import csv
import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tributary.functions import coerce_date, coerce_timestamp
from tributary.plans import cli, jobs
from tributary.sinks.lake import export_csv
from tributary.sources import load_parsed_bronze, load_transformed
from tributary.sources.feed import change_feed
from tributary.sources.kafka import read_kafka_layout_files
from tributary.sources.lake import read_bronze, read_layer


def land(spark, config):
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet"))
    jobs.run_kafka_to_bronze(spark, config, feed, ingested_at=F.col("ingested_at"))


def test_cli_jobs_and_loaders(spark, tmp_lake):
    base = f"file:{tmp_lake}"
    config = jobs.LakeConfig(base_uri=base)
    land(spark, config)
    empty = cli.run(["--base-uri", base, "silver", "--backfill-start-date", "2030-01-01"], spark)
    assert empty.quarantine_rows == 0
    run = cli.run(["--base-uri", base, "silver", "--backfill-start-date", "2024-01-01",
                   "--backfill-end-date", "2024-12-31"], spark)
    assert run.quarantine_rows > 0
    paths = cli.run(["--base-uri", base, "gold"], spark)
    assert "fact_recent_changes" in paths
    rows = cli.run(["--base-uri", base, "dashboard-check"], spark)
    assert rows and not any(r[3] for r in rows)
    parsed = load_parsed_bronze(spark, config.path("bronze"))
    assert parsed.count() == read_bronze(spark, config.path("bronze")).count()
    # without the quality stage, blank titles (null only after clean-up) are kept
    cleaned = load_transformed(spark, config.path("bronze"))
    silver_rows = read_layer(spark, config.path("silver")).count()
    blank_titles = cleaned.where(F.col("page_title").isNull()).count()
    assert cleaned.count() > silver_rows
    assert cleaned.count() - silver_rows <= blank_titles


def test_stream_job_uses_config_paths(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    source = os.path.join(tmp_lake, "src")
    change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet")).drop("ingested_at").write.parquet(source)
    stream = read_kafka_layout_files(spark, source, streaming=True)
    q = jobs.start_kafka_to_bronze_stream(spark, config, stream, available_now=True)
    q.awaitTermination(300)
    assert read_bronze(spark, config.path("bronze")).count() == spark.read.parquet(source).count()
    assert glob.glob(os.path.join(tmp_lake, "checkpoints", "bronze", "offsets", "*"))


def test_export_csv_round_trip(spark, tmp_lake):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 5)], "event_date date, events long")
    path = export_csv(df.coalesce(1), os.path.join(tmp_lake, "export"))
    [part] = glob.glob(os.path.join(path, "part-*.csv"))
    with open(part) as handle:
        rows = list(csv.reader(handle))
    assert rows[0] == ["event_date", "events"]
    assert sorted(rows[1:]) == [["2024-01-01", "3"], ["2024-01-02", "5"]]


def test_lenient_date_coercion(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("garbage",), (None,)], "v string")
    got = df.select(coerce_timestamp("v").alias("t"), coerce_date("v").alias("d")).collect()
    assert got[0]["t"] == dt.datetime(2024, 1, 5, 10, 0) and got[0]["d"] == dt.date(2024, 1, 5)
    assert got[1]["t"] is None and got[1]["d"] is None
    assert got[2]["t"] is None


def test_scheduled_order(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config)
    result = jobs.run_scheduled(spark, config, as_of=dt.datetime(2024, 3, 1), raise_on_failure=False)
    assert set(result) == {"silver", "gold", "checks", "dashboard"}
    assert not any(check == "bronze" for check, *_ in result["checks"])
    assert result["silver"].quarantine_rows > 0
