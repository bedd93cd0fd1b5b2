"""Plan assertions: parse once, pushed filters, top-k, partitioning reuse.

(The no-Python-node check runs per query in test_oracle.py.)
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tributary.plans import catalog
from tributary.sources.lake import read_bronze

QUERIES = catalog.queries()


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_json_parsed_once(spark):
    text = plan_text(QUERIES["silver"](spark, SMALL_SF))
    assert text.count("from_json") == 1
    assert "Generate inline" in text
    # parsed straight from the scan: no RDD round trip before the parse
    assert "Scan ExistingRDD" not in text


SERVING_TABLES = (
    "agg_events_by_type", "agg_events_by_wiki", "agg_top_users", "agg_top_pages", "recent_events_snapshot",
)


@pytest.mark.parametrize("name", SERVING_TABLES)
def test_serving_tables_parse_once_and_join_nothing(spark, name):
    text = plan_text(QUERIES[name](spark, SMALL_SF))
    assert text.count("Generate inline") == 1
    assert "Join" not in text


@pytest.mark.parametrize("name", SERVING_TABLES)
def test_one_pass_tables_equal_the_join_form(spark, name):
    from tributary.operators.gold import build_star_schema, serving_tables_of
    from tributary.plans.catalog import _silver

    silver = _silver(spark, SMALL_SF).persist()
    # equal keys of different attributes: the dimension's row names them both
    odd = silver.limit(40).withColumns({
        "meta_id": F.concat(F.lit("odd-"), "meta_id"),
        "event_user": F.when(F.col("event_id") % 2 == 0, F.lit("__null__")),
        "event_type": F.when(F.col("event_id") % 2 == 0, F.lit("__null__")),
    })
    both = silver.unionByName(odd) if name != "recent_events_snapshot" else silver
    want, got = build_star_schema(both)[name], serving_tables_of(both)[name]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    silver.unpersist()


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("serving_")])
def test_serving_queries_are_built_without_a_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", "query construction")
    try:
        QUERIES[name](spark, SMALL_SF)
        # reading a Parquet footer for the schema is the only job there is
        assert len(tracker.getJobIdsForGroup(f"build-{name}")) <= 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_snapshot_is_top_k(spark):
    from tributary.operators import aggregates
    from tributary.plans.catalog import _model

    m = _model(spark, SMALL_SF)
    top = m["fact_recent_changes"].orderBy("event_datetime").limit(100)
    assert "TakeOrderedAndProject" in plan_text(top)
    snap = aggregates.recent_events_snapshot(m["fact_recent_changes"], m["dim_wiki"], m["dim_page"],
                                             m["dim_user"], m["dim_event_type"])
    assert "TakeOrderedAndProject" in plan_text(snap)


def test_bronze_partition_pruning(spark, tmp_path):
    from tributary.plans import jobs
    from tributary.sources.feed import change_feed

    config = jobs.LakeConfig(base_uri=f"file:{tmp_path}")
    feed = change_feed(spark.read.parquet(f"{SMALL_SF}/events.parquet"))
    jobs.run_kafka_to_bronze(spark, config, feed, ingested_at=F.col("ingested_at"))
    bronze = read_bronze(spark, config.path("bronze")).where(F.col("bronze_ingested_date") >= dt.date(2024, 1, 20))
    text = bronze._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bronze_ingested_date" in text
    projected = bronze.select("kafka_offset")
    assert "ReadSchema: struct<kafka_offset:bigint>" in plan_text(projected)


def test_silver_dedup_then_fact_reuses_partitioning(spark):
    from tributary.operators.star import add_star_schema_keys, build_fact_recent_changes
    from tributary.plans.catalog import _silver

    fact = build_fact_recent_changes(add_star_schema_keys(_silver(spark, SMALL_SF)))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    # one exchange on meta_id for the Silver dedup; the fact dedup reuses it
    assert plan.count("Exchange hashpartitioning(meta_id") == 1
