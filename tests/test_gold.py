import datetime as dt

from pyspark.sql import functions as F

from tributary.operators.aggregates import (
    agg_dashboard_kpis,
    agg_events_by_window,
    recent_events_snapshot,
)
from tributary.operators.gold import build_star_schema
from tributary.operators.star import add_star_schema_keys, build_dimensions, build_fact_recent_changes
from tributary.schemas import GOLD_TABLES

SILVER_SCHEMA = (
    "event_id long, meta_id string, event_type string, event_datetime timestamp, event_date date, "
    "wiki string, domain string, stream_name string, namespace long, page_title string, "
    "page_url string, event_user string, is_bot boolean, is_minor boolean, is_patrolled boolean, "
    "server_name string, comment string, bronze_ingested_at timestamp, source_system string, "
    "message_key string, kafka_topic string, kafka_partition int, kafka_offset long, "
    "kafka_timestamp timestamp"
)


def silver_rows(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(event_id=i, meta_id=f"m{i}", event_type="edit",
                    event_datetime=dt.datetime(2024, 1, 5, 0, 0, 0), wiki="enwiki",
                    domain="en", stream_name="rc", namespace=0, page_title="P", page_url="u",
                    event_user="Ed", is_bot=False, is_minor=False, is_patrolled=False,
                    server_name="en", comment=None, bronze_ingested_at=None, source_system="s",
                    message_key=None, kafka_topic="t", kafka_partition=0, kafka_offset=i,
                    kafka_timestamp=None)
        base.update(r)
        base["event_date"] = base["event_datetime"].date() if base["event_datetime"] else None
        full.append(base)
    cols = [c.split()[0] for c in SILVER_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in full], SILVER_SCHEMA)


def test_fact_names_and_tables(spark):
    tables = build_star_schema(silver_rows(spark, [{}]))
    assert tuple(tables) == GOLD_TABLES
    fact = tables["fact_recent_changes"]
    for name in ("event_id", "date_key", "wiki_key", "page_key", "user_key", "event_type_key",
                 "is_bot", "event_date"):
        assert name in fact.columns


def test_unknown_user_and_bot_flags(spark):
    silver = silver_rows(spark, [{"event_user": None, "is_bot": False},
                                 {"event_user": "Ann", "is_bot": True},
                                 {"event_user": "Ann", "is_bot": False}])
    dims = build_dimensions(add_star_schema_keys(silver))
    users = sorted((r["event_user"], r["is_bot"]) for r in dims["dim_user"].collect())
    assert users == [("Ann", False), ("Ann", True), ("unknown", False)]
    fact = build_fact_recent_changes(add_star_schema_keys(silver))
    assert agg_dashboard_kpis(fact).first()["unique_users"] == 3


def test_window_edges_and_null_times(spark):
    silver = silver_rows(spark, [
        {"event_datetime": dt.datetime(2024, 1, 5, 0, 14, 59, 999000)},
        {"event_datetime": dt.datetime(2024, 1, 5, 0, 15, 0)},
    ])
    fact = build_fact_recent_changes(add_star_schema_keys(silver))
    starts = sorted(r["window_start"] for r in agg_events_by_window(fact).collect())
    assert starts == [dt.datetime(2024, 1, 5, 0, 0), dt.datetime(2024, 1, 5, 0, 15)]
    with_null = fact.withColumn("event_datetime", F.lit(None).cast("timestamp"))
    assert agg_events_by_window(with_null).count() == 0


def test_empty_silver_kpis(spark):
    fact = build_fact_recent_changes(add_star_schema_keys(silver_rows(spark, [{}]).limit(0)))
    row = agg_dashboard_kpis(fact).first()
    assert (row["events"], row["bot_events"], row["unique_users"], row["unique_pages"]) == (0, None, 0, 0)


def test_snapshot_exactly_100_with_tie_key(spark):
    import hashlib

    same = dt.datetime(2024, 1, 5, 1, 0, 0)
    silver = silver_rows(spark, [{"event_datetime": same, "comment": f"c{i}"} for i in range(150)])
    modeled = add_star_schema_keys(silver)
    dims = build_dimensions(modeled)
    fact = build_fact_recent_changes(modeled)
    snap = recent_events_snapshot(fact, dims["dim_wiki"], dims["dim_page"], dims["dim_user"],
                                  dims["dim_event_type"])
    got = sorted(r["comment"] for r in snap.collect())
    by_key = sorted(range(150), key=lambda i: hashlib.sha256(f"m{i}".encode()).hexdigest())
    assert got == sorted(f"c{i}" for i in by_key[:100])


def test_label_joins_keep_fact_count(spark):
    silver = silver_rows(spark, [{"page_title": f"p{i % 3}"} for i in range(20)])
    tables = build_star_schema(silver)
    from tributary.operators.star import build_dashboard_base

    base = build_dashboard_base(tables["fact_recent_changes"], tables["dim_wiki"], tables["dim_page"],
                                tables["dim_user"], tables["dim_event_type"])
    assert base.count() == tables["fact_recent_changes"].count() == 20
    pages = {r["page_title"]: r["events"] for r in tables["agg_top_pages"].collect()}
    assert pages == {"p0": 7, "p1": 7, "p2": 6}
