"""Deduplication of stored rows: only rows whose key repeats are sorted and sent,
and the result is that of ``keep_one_per_key``."""

from pyspark.sql import functions as F

from tests.conftest import event, kafka_frame
from tests.test_gold import silver_rows
from tributary.functions.text import clean_text
from tributary.operators.silver import keep_one_per_key, one_per_repeated_key
from tributary.operators.star import DIMENSION_KEYS, KEY_PARTS, add_star_schema_keys, build_dimensions
from tributary.plans import jobs
from tributary.sources.lake import read_layer

SCHEMA = "meta_id string, kafka_topic string, kafka_partition int, kafka_offset long, payload string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_grouping_all_rows(spark):
    rows = [
        ("a", "t", 0, 5, "later"), ("a", "t", 0, 2, "first"), ("a", "s", 9, 9, "other topic"),
        ("b", "t", 0, 1, "alone"), (None, "t", 1, 1, "null"), (None, "t", 0, 7, "null, lower"),
        ("c", "t", None, 3, "x"), ("c", "t", None, 3, "w"), ("d", "t", 0, 1, "copy"), ("d", "t", 0, 1, "copy"),
        ("", "t", 0, 1, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    want = rows_of(keep_one_per_key(df, "meta_id"))
    for most in (0, 500_000):
        for by in ((), ["kafka_topic"]):
            with one_per_repeated_key(df, "meta_id", by=by, most=most) as keep:
                found = keep(df, "meta_id")
                assert found.columns == df.columns and rows_of(found) == want
                part = df.where("payload <> 'first'")  # keys may repeat in fewer of its rows
                assert rows_of(keep(part, "meta_id")) == rows_of(keep_one_per_key(part, "meta_id"))
    df.unpersist()


def test_rows_of_other_keys_stay(spark, tmp_lake):
    path = f"file:{tmp_lake}/rows"
    spark.range(500).selectExpr(
        "concat('m', id) AS meta_id", "'t' AS kafka_topic", "0 AS kafka_partition", "id AS kafka_offset"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    with one_per_repeated_key(df, "meta_id") as keep:
        assert "Exchange" not in plan_of(keep(df, "meta_id")) and keep(df, "meta_id").count() == 500


def test_jobs_send_only_repeated_rows(spark, tmp_lake, monkeypatch):
    """Silver sorts no row of a single meta_id, and the fact goes from Silver's
    dates to its own without an exchange."""
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    days = [{"id": f"m{i}", "dt": f"2024-01-{1 + i % 5:02d}T00:00:00Z"} for i in range(50)]
    values = [event(id=i, meta=meta) for i, meta in enumerate(days)]
    jobs.run_kafka_to_bronze(spark, config, kafka_frame(spark, values))
    jobs.run_bronze_to_silver(spark, config)
    written = {}

    def noting(gold, tables, *args, **kwargs):
        written.update((name, plan_of(df)) for name, df in tables.items())
        written["dealt"] = written.get("dealt", set()) | set(kwargs.get("dealt", ()))
        return write_tables(gold, tables, *args, **kwargs)

    write_tables = jobs.write_tables
    monkeypatch.setattr(jobs, "write_tables", noting)
    jobs.run_silver_to_gold(spark, config)
    assert "Exchange" not in written["fact_recent_changes"] and written["dealt"] == {"fact_recent_changes"}
    fact = jobs.read_gold_tables(spark, config)["fact_recent_changes"]
    silver = read_layer(spark, config.path("silver"))
    assert fact.count() == silver.count() == 50
    assert len(fact.inputFiles()) <= len(silver.inputFiles())


def test_fact_of_silver_with_copies(spark, tmp_lake):
    """A stored Silver may hold a meta_id twice: the fact doesn't."""
    config = jobs.LakeConfig(base_uri=f"file:{tmp_lake}")
    silver = silver_rows(spark, [{"meta_id": f"m{i % 7}", "kafka_offset": 100 - i} for i in range(20)])
    config.writer("silver").write(silver)
    jobs.run_silver_to_gold(spark, config)
    fact = jobs.read_gold_tables(spark, config)["fact_recent_changes"]
    assert {(r.meta_id, r.kafka_offset) for r in fact.collect()} == {
        (f"m{k}", min(100 - i for i in range(20) if i % 7 == k)) for k in range(7)
    } and fact.count() == 7


def test_dimension_keys_are_hashed_once_per_combination(spark):
    modeled = add_star_schema_keys(silver_rows(spark, [{"event_user": u} for u in ("a", None, "unknown", "a")]))
    for name, dimension in build_dimensions(modeled).items():
        if name != "dim_date":
            plan = plan_of(dimension)
            lowest = plan[plan.rindex("HashAggregate"):]
            assert DIMENSION_KEYS[name] in plan and not any(key in lowest for key in KEY_PARTS), name
    users = build_dimensions(modeled)["dim_user"].orderBy("event_user", "user_key").collect()
    keys = {r[0] for r in modeled.select("user_key").distinct().collect()}
    assert [r.event_user for r in users] == ["a", "unknown", "unknown"] and {r.user_key for r in users} == keys


def test_texts_without_tags(spark):
    texts = ["a > b", "<b>", "<", "a < b", "x<i>y</i>", "", None, " a  b "]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", clean_text("t").alias("c"))
    assert [r.c for r in got.orderBy(F.col("i")).collect()] == ["a > b", "", "<", "a < b", "x y", "", "", "a b"]
