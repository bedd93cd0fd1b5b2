"""A key holding a third of the rows: results stay whole and exact, and the
plans combine the hot key map-side before any shuffle."""


from pyspark.sql import functions as F

from tributary.operators.aggregates import agg_top_pages
from tributary.operators.silver import keep_one_per_key
from tributary.operators.star import add_star_schema_keys, build_dimensions, build_fact_recent_changes
from tests.test_gold import silver_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_meta_id_dedup(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id").cast("string"))).alias("meta_id"),
        F.lit("t").alias("kafka_topic"),
        (F.col("id") % 4).cast("int").alias("kafka_partition"),
        (F.lit(n) - F.col("id")).alias("kafka_offset"),
        F.col("id").alias("payload"),
    ).repartition(6)
    out = keep_one_per_key(df, "meta_id")
    rows = {r["meta_id"]: r for r in out.collect()}
    assert len(rows) == 1 + (n - n // 3)  # nothing dropped
    hot = rows["hot"]
    # lowest (topic, partition, offset) among the hot rows: partition 0, highest id
    expected_id = max(i for i in range(0, n, 3) if i % 4 == 0)
    assert (hot["kafka_partition"], hot["payload"]) == (0, expected_id)
    plan = plan_of(out)
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(meta_id")  # partial below the exchange


def test_hot_page_label_counts(spark):
    rows = [{"page_title": "Hot" if i % 3 == 0 else f"p{i % 40}"} for i in range(600)]
    silver = silver_rows(spark, rows)
    modeled = add_star_schema_keys(silver)
    dims = build_dimensions(modeled)
    fact = build_fact_recent_changes(modeled)
    pages = agg_top_pages(fact, dims["dim_page"])
    got = {r["page_title"]: r["events"] for r in pages.collect()}
    assert got["Hot"] == 200 and sum(got.values()) == 600
    lines = plan_of(pages).splitlines()
    # counts per page key are combined before the join: the join's left input is
    # the per-key aggregate, so the fact itself never enters a join
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "HashAggregate" in lines[join + 1] and "page_key" in lines[join + 1]
