"""Gold refresh by changed dates, key index of Silver, offset ledger."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tributary.plans import gold_refresh, jobs
from tributary.plans.gold_refresh import refresh_gold
from tributary.plans.key_index import KeyIndex
from tributary.plans.landing import land_new_offsets
from tributary.schemas import BRONZE_KEY, GOLD_TABLES
from tributary.sinks.manifest import Manifest
from tributary.sources.dates import date_files
from tributary.sources.feed import FEED_PARTITIONS, FEED_TOPIC, change_feed
from tributary.sources.lake import delete_folder, read_bronze, read_layer

AS_OF = dt.datetime(2024, 3, 1)
DAY = dt.date(2024, 1, 12)
LATE = f"to_date(ts) = date'{DAY}' and event_id % 100 between 20 and 60"


def events(spark):
    return spark.read.parquet(f"{SMALL_SF}/events.parquet")


def land(spark, config, rows):
    jobs.run_kafka_to_bronze(spark, config, change_feed(rows), ingested_at=F.col("ingested_at"))


def silver(spark, config, *window):
    jobs.run_bronze_to_silver(spark, config, 2, *window, as_of=AS_OF)


def tables(spark, config):
    return {
        name: sorted(map(str, df.select(*sorted(df.columns)).collect()))
        for name, df in jobs.read_gold_tables(spark, config, GOLD_TABLES).items()
    }


@pytest.fixture()
def lake(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    land(spark, config, events(spark).where(f"not ({LATE})"))
    silver(spark, config)
    return config


def change_one_date(spark, config):
    land(spark, config, events(spark).where(LATE))
    silver(spark, config, DAY, DAY)


def test_refresh_reads_the_changed_date_and_equals_a_rebuild(spark, lake):
    first = refresh_gold(spark, lake)
    assert len(first.changed) == len(date_files(spark, lake.path("silver"))) and not first.gone
    before = tables(spark, lake)
    change_one_date(spark, lake)
    second = refresh_gold(spark, lake)
    assert second.changed == [str(DAY)] and not second.gone
    refreshed = tables(spark, lake)
    assert refreshed != before
    jobs.run_silver_to_gold(spark, lake)
    assert refreshed == tables(spark, lake)
    assert refresh_gold(spark, lake) == gold_refresh.GoldRefresh({}, [], [])


def test_states_read_the_stored_fact(spark, lake, monkeypatch):
    states, read = gold_refresh.partial_states, []

    def partial_states(silver, fact):
        read.append((fact.inputFiles(), {r.event_date for r in fact.select("event_date").distinct().collect()}))
        return states(silver, fact)

    monkeypatch.setattr(gold_refresh, "partial_states", partial_states)
    refresh_gold(spark, lake)
    change_one_date(spark, lake)
    refresh_gold(spark, lake)
    assert len(read) == 2 and read[1][1] == {DAY}
    for files, _ in read:
        assert files and all("/gold/recent_changes/fact_recent_changes/" in f for f in files)


def test_refresh_drops_dates_that_are_gone(spark, lake):
    refresh_gold(spark, lake)
    gone = sorted(date_files(spark, lake.path("silver")))[3]
    delete_folder(spark, f"{lake.path('silver')}/event_date={gone}")
    found = refresh_gold(spark, lake)
    assert found.gone == [gone] and not found.changed
    refreshed = tables(spark, lake)
    jobs.run_silver_to_gold(spark, lake)
    assert refreshed == tables(spark, lake)


def test_refresh_after_a_stopped_run(spark, lake, monkeypatch):
    """A run that stops before its manifest is repeated from the same start."""
    refresh_gold(spark, lake)
    change_one_date(spark, lake)
    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "publish", lambda self, content: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            refresh_gold(spark, lake)
    assert refresh_gold(spark, lake).changed == [str(DAY)]
    refreshed = tables(spark, lake)
    jobs.run_silver_to_gold(spark, lake)
    assert refreshed == tables(spark, lake)


def test_refresh_of_an_empty_silver(spark, tmp_lake, lake):
    """All dates gone: empty breakdowns, no events, no users."""
    refresh_gold(spark, lake)
    for date in date_files(spark, lake.path("silver")):
        if date != str(DAY):
            delete_folder(spark, f"{lake.path('silver')}/event_date={date}")
    refresh_gold(spark, lake)
    kpis = jobs.read_gold_tables(spark, lake, ["agg_dashboard_kpis"])["agg_dashboard_kpis"].first()
    left = read_layer(spark, lake.path("silver"))
    assert kpis.events == left.count() > 0
    assert kpis.unique_users == left.select("event_user", "is_bot").distinct().count()


def test_manifest_versions(spark, tmp_lake):
    manifest = Manifest(spark, f"file:{tmp_lake}/m")
    assert manifest.current() is None
    for n in range(5):
        manifest.publish({"n": n})
    assert manifest.current() == {"n": 4}
    assert manifest._versions() == [3, 4, 5]


# --- key index ------------------------------------------------------------------


def key_index(spark, config):
    return KeyIndex(spark, config.path("silver_keys"), config.path("silver"))


def outside(spark, config, dates):
    with key_index(spark, config).outside(dates) as keys:
        return [] if keys is None else sorted(r.meta_id for r in keys.collect())


def expected(spark, config, dates):
    rows = read_layer(spark, config.path("silver")).where(~F.col("event_date").cast("string").isin(dates))
    return sorted(r.meta_id for r in rows.select("meta_id").collect())


def test_index_follows_silver(spark, lake, monkeypatch):
    inside = [str(DAY), "2024-01-13"]
    assert outside(spark, lake, inside) == expected(spark, lake, inside)
    folder = key_index(spark, lake).manifest.current()["folder"]
    change_one_date(spark, lake)
    assert outside(spark, lake, ["2024-01-13"]) == expected(spark, lake, ["2024-01-13"])
    now = key_index(spark, lake).manifest.current()
    assert (now["folder"], now["appends"]) == (folder, 1)
    monkeypatch.setattr("tributary.plans.key_index.RUNS", 1)
    silver(spark, lake, DAY, DAY)
    assert outside(spark, lake, inside) == expected(spark, lake, inside)
    assert key_index(spark, lake).manifest.current()["folder"] != folder
    silver(spark, lake)  # every date anew
    assert outside(spark, lake, inside) == expected(spark, lake, inside)
    assert outside(spark, lake, list(date_files(spark, lake.path("silver")))) == []


def test_index_is_joined_without_an_exchange_of_it(spark, lake):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    window = read_layer(spark, lake.path("silver")).where(F.col("event_date") == DAY)
    with key_index(spark, lake).outside([str(DAY)]) as keys:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = window.join(keys, "meta_id", "left_anti")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert joined.count() == window.count()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    stored = plan[plan.index("Bucketed: true") - 600 :]
    assert "Exchange hashpartitioning" not in stored


# --- offset ledger ----------------------------------------------------------------


def test_ledger_asks_for_new_offsets_only(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    feed, asked = change_feed(events(spark)), []

    def reader(rows):
        def read(starting, ending):
            asked.append((json.loads(starting), ending))
            return rows

        return read

    def batch(rows):
        return land_new_offsets(spark, config, reader(rows), {FEED_TOPIC: FEED_PARTITIONS}, F.col("ingested_at"))

    earliest = {FEED_TOPIC: dict.fromkeys("012", -2)}
    first = batch(feed.where("offset < 40"))
    assert first.starting == earliest and first.following == {FEED_TOPIC: dict.fromkeys("012", 40)}
    batch(feed)
    assert asked[1] == (first.following, "latest")
    again = batch(feed)
    assert again.starting == again.following
    landed = read_bronze(spark, config.path("bronze"))
    assert landed.count() == feed.count() == landed.select(*BRONZE_KEY).distinct().count()


@pytest.mark.parametrize("closed", [True, False])
def test_ledger_after_older_landings_and_stopped_runs(spark, tmp_lake, closed, monkeypatch):
    """Rows that a batch without a ledger, or a stopped run, had landed stay single."""
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    feed = change_feed(events(spark))

    def batch(rows):
        return land_new_offsets(spark, config, lambda s, e: rows, {FEED_TOPIC: FEED_PARTITIONS}, F.col("ingested_at"))

    if closed:
        land(spark, config, events(spark).where("event_id % 2 = 0"))
    else:
        real = Manifest.publish

        def stop(self, content):
            if not content["open"]:
                raise RuntimeError("stopped")
            return real(self, content)

        with monkeypatch.context() as patch:
            patch.setattr(Manifest, "publish", stop)
            with pytest.raises(RuntimeError, match="stopped"):
                batch(feed.where("offset < 40"))
    batch(feed)
    landed = read_bronze(spark, config.path("bronze"))
    assert landed.count() == feed.count() == landed.select(*BRONZE_KEY).distinct().count()
    assert batch(feed).starting == {FEED_TOPIC: {str(p): int(feed.where(f"partition = {p}").agg(F.max("offset")).first()[0]) + 1 for p in range(3)}}


def test_ledger_takes_partitions_nobody_listed(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    feed = change_feed(events(spark))
    found = land_new_offsets(spark, config, lambda s, e: feed, {FEED_TOPIC: 1}, F.col("ingested_at"))
    assert set(found.following[FEED_TOPIC]) == {"0", "1", "2"}
