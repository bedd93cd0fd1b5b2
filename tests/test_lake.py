"""Bronze folders, storage guard, Silver after any run order, exports."""

import datetime as dt
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF, event, kafka_frame
from tributary.operators.checks import duplicate_key_groups
from tributary.plans import jobs
from tributary.schemas import BRONZE_KEY, KAFKA_SCHEMA
from tributary.sinks.lake import export_dashboard, preview
from tributary.sources.feed import change_feed
from tributary.sources.kafka import load_from_kafka, read_kafka, read_kafka_stream
from tributary.sources.lake import child_folders, has_data_files, read_bronze, read_layer

AS_OF = dt.datetime(2024, 3, 1)


def test_guard_sees_visible_files_only(spark, tmp_lake):
    assert not has_data_files(spark, f"file:{tmp_lake}/missing")
    os.makedirs(f"{tmp_lake}/t/_spark_metadata")
    os.makedirs(f"{tmp_lake}/t/d=1")
    for name in ("_SUCCESS", "_spark_metadata/0", ".part-0.crc", "d=1/.hidden"):
        with open(f"{tmp_lake}/t/{name}", "w") as f:
            f.write("x")
    assert not has_data_files(spark, f"file:{tmp_lake}/t")
    with open(f"{tmp_lake}/t/d=1/part-0", "w") as f:
        f.write("x")
    assert has_data_files(spark, f"file:{tmp_lake}/t")
    assert child_folders(spark, f"file:{tmp_lake}/t") == ["d=1"]
    assert child_folders(spark, f"file:{tmp_lake}/missing") == []


def test_guard_raises_storage_errors(spark, tmp_lake):
    with pytest.raises(Py4JJavaError):
        has_data_files(spark, "nosuchstore://bucket/bronze")
    config = jobs.LakeConfig(base_uri="nosuchstore://bucket")
    with pytest.raises(Py4JJavaError):
        jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, [event()]), only_new_offsets=True)


def test_bronze_is_the_union_of_all_landings(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet"))
    old = feed.where("offset % 3 = 0")
    # a folder written before the batch and stream folders existed
    jobs.run_kafka_to_bronze(spark, config, old, ingested_at=F.col("ingested_at"))
    os.rename(f"{tmp_lake}/bronze/recent_changes/batch", f"{tmp_lake}/old")
    os.rename(f"{tmp_lake}/old", f"{tmp_lake}/bronze/recent_changes_")
    os.rmdir(f"{tmp_lake}/bronze/recent_changes")
    os.rename(f"{tmp_lake}/bronze/recent_changes_", f"{tmp_lake}/bronze/recent_changes")
    assert read_bronze(spark, config.path("bronze")).count() == old.count()
    source = f"{tmp_lake}/src"
    feed.where("offset % 3 = 1").drop("ingested_at").write.parquet(source)
    stream = read_kafka_stream(
        spark, "unused:9092", "changes", options={"path": source}, source_format="parquet", schema=KAFKA_SCHEMA
    )
    jobs.start_kafka_to_bronze_stream(spark, config, stream, available_now=True).awaitTermination()
    jobs.run_kafka_to_bronze(spark, config, feed, only_new_offsets=True, ingested_at=F.col("ingested_at"))
    bronze = read_bronze(spark, config.path("bronze"))
    assert bronze.count() == feed.count()
    assert duplicate_key_groups(bronze, list(BRONZE_KEY)).first()[0] == 0
    pruned = bronze.where(F.col("bronze_ingested_date") == dt.date(2024, 1, 20))
    assert pruned._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(") == 3


def test_new_offsets_read_no_bronze_below_the_batch(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    rows = [(event(id=i), i % 2, i // 2) for i in range(40)]
    jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, rows), ingested_at=AS_OF)
    landed = read_bronze(spark, config.path("bronze"))
    batch = jobs.to_bronze(kafka_frame(spark, rows[30:]))
    lowest = jobs.lowest_offsets(batch)
    assert {(r.kafka_partition, r.lowest) for r in lowest} == {(0, 15), (1, 15)}
    met = jobs.landed_from(landed, lowest)
    assert sorted(r.kafka_offset for r in met.collect()) == [15, 15, 16, 16, 17, 17, 18, 18, 19, 19]
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kafka_partition,0),GreaterThanOr" in plan  # PushedFilters (the text is cut)
    assert "PartitionFilters: [isnotnull(kafka_topic" in plan
    # a partition that the batch does not know is compared as a whole
    assert jobs.landed_from(landed, lowest[:1]).count() == 20 + 5


def copies(*rows):
    """(meta_id, day of January, partition, offset) -> Kafka rows."""
    return [
        (event(id=i + 1, meta={"id": m, "dt": f"2024-01-{day:02d}T10:00:00Z"}), partition, offset)
        for i, (m, day, partition, offset) in enumerate(rows)
    ]


def silver_rows(spark, config):
    rows = read_layer(spark, config.path("silver")).select("meta_id", F.dayofmonth("event_date"), "kafka_partition", "kafka_offset")
    return sorted(map(tuple, rows.collect()))


def land(spark, config, rows, **kwargs):
    jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, copies(*rows)), ingested_at=AS_OF, **kwargs)


def test_windowed_rerun_adds_no_second_copy(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config, [("a", 5, 0, 0), ("a", 6, 0, 1), ("b", 6, 0, 2), ("c", 7, 1, 0)])
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    full = silver_rows(spark, config)
    assert full == [("a", 5, 0, 0), ("b", 6, 0, 2), ("c", 7, 1, 0)]
    for day in ("2024-01-06", "2024-01-05", "2024-01-07"):
        jobs.run_bronze_to_silver(spark, config, start=day, end=day, as_of=AS_OF)
        assert silver_rows(spark, config) == full
    jobs.run_bronze_to_silver(spark, config, lookback_days=55, as_of=AS_OF)
    assert silver_rows(spark, config) == full


def test_moved_survivor_leaves_no_old_row(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config, [("a", 5, 1, 0), ("b", 8, 1, 1)])
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    land(spark, config, [("a", 6, 0, 0)])
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 6, 0, 0), ("b", 8, 1, 1)]
    # the same move inside a window: the date without rows is dropped
    land(spark, config, [("a", 4, 0, -1)])
    jobs.run_bronze_to_silver(spark, config, start="2024-01-04", end="2024-01-06", as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 4, 0, -1), ("b", 8, 1, 1)]
    # a stored row outside the window wins over the window's copies
    land(spark, config, [("b", 3, 0, -2)])
    jobs.run_bronze_to_silver(spark, config, start="2024-01-03", end="2024-01-03", as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 4, 0, -1), ("b", 8, 1, 1)]
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 4, 0, -1), ("b", 3, 0, -2)]


def test_windowed_run_scans_the_ingest_dates_it_needs(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    days = {d: dt.datetime(2024, 1, d, 12) for d in (5, 6, 7)}
    first = [("a", 5, 0, 0), ("b", 6, 0, 1), ("c", 7, 0, 2)]
    for row, day in zip(first, days.values(), strict=True):
        jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, copies(row)), ingested_at=day)
    # on the 7th a late row, a row from an early clock and a rejected one land
    late = [*copies(("late", 1, 1, 0), ("early", 30, 1, 1)), ("no json", 1, 2)]
    jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, late), ingested_at=days[7])
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    full = silver_rows(spark, config)
    rejected = read_layer(spark, config.path("quarantine")).count()

    def scanned(first, last):
        landed = jobs._landed_dates(spark, config)
        records = jobs._window_records(spark, config, landed)
        bronze = read_bronze(spark, config.path("bronze"))
        df = jobs.bronze_in_window(spark, bronze, records, F.lit(first).cast("date"), F.lit(last).cast("date"))
        dates = {r[0].day for r in df.select("bronze_ingested_date").distinct().collect()}
        return dates, df._jdf.queryExecution().executedPlan().toString()

    dates, plan = scanned("2024-01-05", "2024-01-05")
    assert dates == {5, 7}  # the 7th holds dates from the 1st to the 30th
    assert "PartitionFilters: [" in plan and "bronze_ingested_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert scanned("2024-01-06", "2024-01-06")[0] == {6, 7}
    for day in (1, 5, 6, 7, 30):
        jobs.run_bronze_to_silver(spark, config, start=f"2024-01-{day:02d}", end=f"2024-01-{day:02d}", as_of=AS_OF)
        assert silver_rows(spark, config) == full
        assert read_layer(spark, config.path("quarantine")).count() == rejected
    # a row that lands later on a recorded date makes its record void
    jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, copies(("d", 6, 2, 0))), ingested_at=days[5])
    assert scanned("2024-01-06", "2024-01-06")[0] == {5, 6, 7}
    jobs.run_bronze_to_silver(spark, config, start="2024-01-06", end="2024-01-06", as_of=AS_OF)
    assert silver_rows(spark, config) == sorted([*full, ("d", 6, 2, 0)])
    assert scanned("2024-01-07", "2024-01-07")[0] == {7}


def test_stream_files_count_when_they_are_committed(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    source = f"{tmp_lake}/src"

    def stream(rows):
        kafka_frame(spark, copies(*rows)).write.mode("append").parquet(source)
        files = read_kafka_stream(
            spark, "unused:9092", "rc", options={"path": source}, source_format="parquet", schema=KAFKA_SCHEMA
        )
        jobs.start_kafka_to_bronze_stream(spark, config, files, available_now=True).awaitTermination()

    stream([("a", 5, 0, 0)])
    [(date, size)] = jobs._landed_dates(spark, config).items()
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    assert len(jobs._window_records(spark, config, {date: size})) == 1
    # a file that no batch has committed is not read, and does not count
    folder = f"{tmp_lake}/bronze/recent_changes/stream/bronze_ingested_date={date}/kafka_topic=rc"
    with open(f"{folder}/part-uncommitted.parquet", "wb") as f:
        f.write(b"x")
    assert jobs._landed_dates(spark, config) == {date: size}
    stream([("b", 9, 0, 1)])
    landed = jobs._landed_dates(spark, config)
    assert sum(files for files, _ in landed.values()) == size[0] + 1
    jobs.run_bronze_to_silver(spark, config, start="2024-01-09", end="2024-01-09", as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 5, 0, 0), ("b", 9, 0, 1)]


def test_first_run_may_be_windowed(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config, [("a", 5, 0, 0), ("a", 6, 0, 1)])
    jobs.run_bronze_to_silver(spark, config, start="2024-01-06", as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 6, 0, 1)]
    jobs.run_bronze_to_silver(spark, config, start="2024-01-05", end="2024-01-05", as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 6, 0, 1)]
    jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    assert silver_rows(spark, config) == [("a", 5, 0, 0)]


def test_far_seconds_do_not_stop_gold(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    rows = [(event(meta={"dt": "bad"}, timestamp=7_000_000_000_000), 0, 0), (event(), 0, 1)]
    jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, rows), ingested_at=AS_OF)
    run = jobs.run_bronze_to_silver(spark, config, as_of=AS_OF)
    assert run.quarantine_rows == 1
    jobs.run_silver_to_gold(spark, config)
    assert jobs.read_gold_tables(spark, config)["dim_date"].count() == 1


def test_layers_have_formats_and_modes_of_their_own(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}", formats={"quarantine": "json"}, modes={"bronze": "overwrite"})
    for _ in range(2):
        land(spark, config, [("a", 5, 0, 0)])
    assert read_bronze(spark, config.path("bronze")).count() == 1
    jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, [("no json", 0, 5), (event(), 0, 6)]), ingested_at=AS_OF)
    assert jobs.run_bronze_to_silver(spark, config, as_of=AS_OF).quarantine_rows == 1
    assert spark.read.json(config.path("quarantine")).count() == 1
    assert jobs.lake_metrics(spark, config, skip_bronze=True) if has_data_files(spark, config.path("gold")) else True


def test_no_quarantine_rows(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config, [("a", 5, 0, 0)])
    assert jobs.run_bronze_to_silver(spark, config, strict=True, as_of=AS_OF).quarantine_rows == 0


def test_kafka_readers_pass_their_options(spark, tmp_lake):
    source = f"{tmp_lake}/src"
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet"))
    feed.drop("ingested_at").write.parquet(source)
    scan = read_kafka(spark, "unused:9092", "changes", options={"path": source}, source_format="parquet", schema=KAFKA_SCHEMA)
    assert scan.schema == KAFKA_SCHEMA and scan.count() == feed.count()
    assert load_from_kafka(scan, AS_OF).where("event_id is not null").count() > 0


def test_dashboard_exports(spark, tmp_lake):
    from tributary.plans import catalog

    paths = export_dashboard(catalog._views(spark, SMALL_SF), f"file:{tmp_lake}/exports")
    assert list(paths) == ["events_by_date", "event_types", "top_pages", "recent_events"]
    back = spark.read.option("header", True).csv(paths["recent_events"])
    assert "event_datetime" in back.columns and 0 < back.count() <= catalog.RECENT_ROWS


def test_preview_shows_schema_and_rows(spark, capsys):
    preview(spark.createDataFrame([(1, "x" * 40)], "v int, long_text string"))
    shown = capsys.readouterr().out
    assert "long_text: string" in shown and "x" * 40 in shown
