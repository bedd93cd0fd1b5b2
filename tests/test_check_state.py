"""Layer checks from the states of dates against the checks of whole layers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tributary.plans import jobs
from tributary.plans.check_state import lake_metrics_by_state
from tributary.plans.key_index import KeyIndex
from tributary.sources.dates import date_files
from tributary.sources.feed import change_feed
from tributary.sources.lake import delete_folder, read_layer

DAY = dt.date(2024, 1, 12)


def whole(spark, config):
    return sorted(map(tuple, jobs.lake_metrics(spark, config, skip_bronze=True).collect()))


def by_state(spark, config):
    report, read = lake_metrics_by_state(spark, config, skip_bronze=True)
    return sorted(map(tuple, report.collect())), read


@pytest.fixture()
def lake(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    events = spark.read.parquet(f"{SMALL_SF}/events.parquet")
    jobs.run_kafka_to_bronze(spark, config, change_feed(events), ingested_at=F.col("ingested_at"))
    jobs.run_bronze_to_silver(spark, config, 2, as_of=dt.datetime(2024, 3, 1))
    jobs.run_silver_to_gold(spark, config)
    return config


def test_changed_dates_only(spark, lake):
    path = lake.path("silver")
    every = sorted(date_files(spark, path))
    first, read = by_state(spark, lake)
    assert first == whole(spark, lake) and read["silver"] == read["fact_recent_changes"] == every
    assert by_state(spark, lake) == (first, {"silver": [], "fact_recent_changes": []})

    # Copies of another date's rows, and a null: duplicates across dates are seen.
    copied = read_layer(spark, path).where(F.col("event_date") == dt.date.fromisoformat(every[0]))
    n = copied.count()
    nulls = {(c, m): v for c, m, v, _ in first}["silver", "null_page_title"]
    changed = copied.withColumns({"event_date": F.lit(DAY), "page_title": F.lit(None).cast("string")})
    changed.write.mode("append").partitionBy("event_date").parquet(path)
    found, read = by_state(spark, lake)
    assert read == {"silver": [str(DAY)], "fact_recent_changes": []}
    assert found == whole(spark, lake)
    value = {(c, m): (v, failed) for c, m, v, failed in found}
    assert value["silver", "duplicate_keys"] == (n, True) and value["silver", "null_page_title"] == (n + nulls, True)

    delete_folder(spark, f"{path}/event_date={every[0]}")
    found, read = by_state(spark, lake)
    assert read["silver"] == [] and found == whole(spark, lake)
    assert ("silver", "duplicate_keys", 0, False) in found


def test_other_partitions_are_read_whole(spark, tmp_lake, lake):
    config = jobs.LakeConfig(base_uri=lake.base_uri, silver_path="silver/plain", silver_partitions="")
    read_layer(spark, lake.path("silver")).write.parquet(config.path("silver"))
    found, read = by_state(spark, config)
    assert read["silver"] == [] and found == whole(spark, config)


def test_keys_are_counted_without_an_exchange(spark, lake):
    index = KeyIndex(spark, lake.path("silver_keys"), lake.path("silver"))
    with index.counts() as counts:
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert counts.count() == read_layer(spark, lake.path("silver")).count()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
    assert index.duplicates() == 0
