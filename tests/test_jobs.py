import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tributary.operators.checks import ChecksFailedError
from tributary.operators.quality import QuarantineGateError
from tributary.plans import jobs
from tributary.schemas import GOLD_TABLES
from tributary.sinks.lake import write_layer
from tributary.sources.feed import change_feed
from tributary.sources.lake import MissingDataError, read_bronze, read_layer

AS_OF = dt.datetime(2024, 3, 1)


def land(spark, config, only_new=False):
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet"))
    return jobs.run_kafka_to_bronze(spark, config, feed, only_new_offsets=only_new,
                                    ingested_at=F.col("ingested_at"))


def test_full_run_and_reruns(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    events = spark.read.parquet(f"{SMALL_SF}/events.parquet").count()
    land(spark, config)
    bronze = read_bronze(spark, config.path("bronze"))
    assert bronze.count() == events
    # batch rerun from earliest: only offsets not landed yet are appended
    land(spark, config, only_new=True)
    assert read_bronze(spark, config.path("bronze")).count() == events

    run = jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    silver = read_layer(spark, config.path("silver"))
    quarantine = read_layer(spark, config.path("quarantine"))
    silver_rows, quarantine_rows = silver.count(), quarantine.count()
    assert run.quarantine_rows == quarantine_rows > 0
    assert silver_rows > 0
    # a rerun replaces the processed dates instead of appending duplicates
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    assert read_layer(spark, config.path("silver")).count() == silver_rows
    assert read_layer(spark, config.path("quarantine")).count() == quarantine_rows

    paths = jobs.run_silver_to_gold(spark, config)
    assert tuple(paths) == GOLD_TABLES
    jobs.run_silver_to_gold(spark, config)
    gold = jobs.read_gold_tables(spark, config)
    assert gold["recent_events_snapshot"].count() <= 100
    assert gold["fact_recent_changes"].count() == silver_rows

    metrics = jobs.run_checks(spark, config, raise_on_failure=False)
    failed = {(c, m) for c, m, v, f in metrics if f}
    # the feed's "<b></b>" titles pass the required check but clean to null
    assert failed == {("silver", "null_page_title")}
    report = jobs.lake_metrics(spark, config)  # the same metrics, still lazy
    assert sorted(tuple(r) for r in report.collect()) == sorted(metrics)
    without_bronze = jobs.lake_metrics(spark, config, skip_bronze=True).collect()
    assert {r[0] for r in without_bronze} == {c for c, *_ in metrics} - {"bronze"}
    with pytest.raises(ChecksFailedError, match="null_page_title"):
        jobs.run_checks(spark, config)
    ready = jobs.run_dashboard_check(spark, config)
    assert all(not f for *_, f in ready)
    with pytest.raises(ChecksFailedError, match="total_events"):
        jobs.run_dashboard_check(spark, config, min_fact_rows=10**9)


def test_strict_gate_fires_after_writes(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config)
    with pytest.raises(QuarantineGateError):
        jobs.run_bronze_to_silver(spark, config, strict=True, as_of=AS_OF)
    assert read_layer(spark, config.path("silver")).count() > 0


def test_windowed_run_and_dynamic_overwrite_keep_other_dates(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config)
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    full = read_layer(spark, config.path("silver"))
    per_date = {r[0]: r[1] for r in full.groupBy("event_date").count().collect()}
    one_day = sorted(per_date)[0]
    jobs.run_bronze_to_silver(spark, config, start=one_day, end=one_day, as_of=AS_OF)
    again = {r[0]: r[1] for r in read_layer(spark, config.path("silver")).groupBy("event_date").count().collect()}
    assert again == per_date


def test_write_modes(spark, tmp_lake):
    path = f"file:{tmp_lake}/t"
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, d date")
    write_layer(df, path, mode="overwrite", partition_by="d")
    write_layer(df.where("v = 2").withColumn("v", F.lit(20)), path, mode="overwrite",
                partition_by="d", overwrite_partitions="dynamic")
    got = sorted(tuple(r) for r in read_layer(spark, path).select("v", "d").collect())
    assert got == [(1, dt.date(2024, 1, 1)), (20, dt.date(2024, 1, 2))]


def test_missing_layer_raises_clear_error(spark, tmp_lake):
    with pytest.raises(MissingDataError):
        read_layer(spark, f"file:{tmp_lake}/nothing")
