"""The CSV exports read a stored Silver; the feed is derived once for all four."""

from pyspark.sql import functions as F

from tests.conftest import BASE_TS
from tributary.plans import catalog


def test_exports_derive_silver_once(spark, tmp_path, monkeypatch):
    events = spark.range(40).select(
        F.col("id").alias("event_id"), F.lit(BASE_TS).cast("timestamp_ntz").alias("ts"), (F.col("id") % 3).alias("user_id"),
        F.lit("click").alias("event_type"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    made, stored = [], []
    silver, write = catalog._silver, catalog.write_layer
    monkeypatch.setattr(catalog, "_silver", lambda *a: made.append(1) or silver(*a))
    monkeypatch.setattr(catalog, "write_layer", lambda *a, **k: stored.append(a[1]) or write(*a, **k))
    found = {r.export: r.rows for r in catalog.q_csv_exports(spark, str(tmp_path)).collect()}
    assert set(found) == {"events_by_date", "event_types", "top_pages", "recent_events"}
    assert len(made) == 1 and len(stored) == 1
