"""Published versions of layers, and the dashboard base from Silver."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tests.test_gold import silver_rows
from tributary.operators.dashboard_base import dashboard_base_of, disputed_labels
from tributary.operators.gold import build_model
from tributary.operators.star import add_star_schema_keys, build_dashboard_base
from tributary.plans import jobs
from tributary.plans.publication import publish, publish_lake, published
from tributary.sources.feed import change_feed
from tributary.sources.lake import child_folders, read_gold_table, read_layer

OPTIONS = {"late_arrival_days": 2, "as_of": dt.datetime(2024, 3, 1)}


@pytest.fixture()
def lake(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet"))
    jobs.run_kafka_to_bronze(spark, config, feed, ingested_at=F.col("ingested_at"))
    return config


def rows(spark, config):
    return read_gold_table(spark, config.path("gold"), "fact_recent_changes").count()


def test_a_stopped_run_leaves_the_published_version(spark, lake):
    first = publish_lake(spark, lake, **OPTIONS)
    held = rows(spark, first)
    open_frame = read_layer(spark, first.path("silver"))

    def stops(fresh):
        jobs.run_bronze_to_silver(spark, fresh, 2, dt.date(2024, 1, 12), dt.date(2024, 1, 12), as_of=OPTIONS["as_of"])
        assert 0 < read_layer(spark, fresh.path("silver")).count() < held
        assert published(spark, lake) == first  # nothing is switched while it writes
        raise OSError("stopped")

    with pytest.raises(OSError, match="stopped"):
        publish(spark, lake, stops)
    assert published(spark, lake) == first and rows(spark, first) == held
    assert open_frame.count() == held
    assert child_folders(spark, lake.path("silver") + "_versions") == [first.path("silver").rsplit("/", 1)[1]]


def test_layers_switch_together_and_the_previous_version_stays(spark, tmp_lake):
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")

    def writes(n, *layers):
        def job(fresh):
            for name in layers:
                spark.range(n).write.parquet(fresh.path(name, "t"))
            return n

        return publish(spark, config, job, layers)

    def seen(lake):
        return [spark.read.parquet(lake.path(n, "t")).count() for n in ("silver", "gold")]

    assert writes(3, "silver", "gold") == 3
    first = published(spark, config)
    writes(4, "silver", "gold")
    second = published(spark, config)
    assert seen(first) == [3, 3] and seen(second) == [4, 4]
    writes(5, "gold")  # one layer alone: the other stays as published
    third = published(spark, config)
    assert third.path("silver") == second.path("silver") and seen(third) == [4, 5] and seen(second) == [4, 4]
    assert len(child_folders(spark, config.path("gold") + "_versions")) == 2  # the first is gone


def test_windowed_runs_and_unknown_layers_are_refused(spark, tmp_lake):
    lake = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    with pytest.raises(ValueError, match="lookback_days"):
        publish_lake(spark, lake, lookback_days=3, **OPTIONS)
    with pytest.raises(ValueError, match="bronze"):
        publish(spark, lake, lambda fresh: None, ["bronze"])
    assert published(spark, lake) == lake


def odd_silver(spark):
    """Events whose keys are shared by different labels, in every dimension."""
    plain = [{"page_title": f"p{i % 5}", "event_user": f"u{i % 3}"} for i in range(30)]
    odd = [
        {"event_user": None}, {"event_user": "__null__"}, {"event_user": "__null__"},
        {"page_title": "a||b", "page_url": "c"}, {"page_title": "a", "page_url": "b||c"},
        {"event_type": "__null__"}, {"wiki": "x||y", "domain": "z"}, {"wiki": "x", "domain": "y||z"},
        {"page_title": "x", "page_url": None}, {"page_title": "x", "page_url": "__null__"},
        {"namespace": None}, {"is_bot": True}, {"page_title": "edge|", "page_url": "t"}, {"page_title": "edge", "page_url": "|t"},
    ]
    return silver_rows(spark, plain + odd)


@pytest.mark.parametrize("bound", [0, 1, 10_000])
def test_base_of_silver_equals_the_joined_one(spark, bound):
    silver = odd_silver(spark)
    m = build_model(silver)
    want = build_dashboard_base(m["fact_recent_changes"], m["dim_wiki"], m["dim_page"], m["dim_user"], m["dim_event_type"])
    got = dashboard_base_of(silver, broadcast_keys=bound)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_disputed_keys_are_those_of_several_labels(spark):
    events = add_star_schema_keys(odd_silver(spark))
    found = {d: [r[1].asDict() for r in disputed_labels(events, d).collect()] for d in ("dim_user", "dim_page", "dim_wiki", "dim_event_type")}
    assert [x["event_user"] for x in found["dim_user"]] == ["__null__"]
    assert sorted(x["page_title"] for x in found["dim_page"]) == ["a", "edge"]
    assert [x["wiki"] for x in found["dim_wiki"]] == ["x"] and found["dim_event_type"] == []


def test_base_of_silver_shuffles_no_event(spark, lake):
    jobs.run_bronze_to_silver(spark, lake, **OPTIONS)
    base = dashboard_base_of(read_layer(spark, lake.path("silver")))
    assert "Exchange" not in base._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
