"""Benchmark: the lakehouse jobs and headline queries on the driver tables.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) and prints one JSON line. Each step is timed
``$BENCH_REPEAT`` times (default 3) after a warm-up; the median is reported.

Steps (a lake folder under the session's checkpoint folder):
  land_bronze      change feed from ``events`` -> Bronze (W4, batch)
  bronze_to_silver Bronze -> Silver + quarantine (W2)
  silver_to_gold   Silver -> 14 Gold tables (W3)
  lake_checks      Silver, quarantine and Gold checks (W5)
  dashboard_check  serving tables ready (Q17)
  serving_views    dashboard views over Gold, collected (V1-V5)
  q_window_e2e     feed -> ... -> events per 15-minute window, one lazy plan
  q_top_pages_e2e  feed -> ... -> top pages, one lazy plan
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tributary.operators import serving  # noqa: E402
from tributary.plans import catalog, jobs  # noqa: E402
from tributary.session import checkpoint_dir, local_session, use_utc  # noqa: E402
from tributary.sources.feed import change_feed  # noqa: E402

AS_OF = catalog.AS_OF


def _sf_of(path: str) -> float | str:
    name = os.path.basename(path.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = use_utc(local_session(cpus, shuffle_partitions=int(cpus) if cpus != "*" else 8, app="bench"))
    # Lakes live in the shared folder named by spark.checkpoint.dir (a local
    # folder is made only when it is unset in local mode).
    root = checkpoint_dir(spark).rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        root = f"file:{root}"
    root = f"{root}/bench-{os.getpid()}-{int(time.time())}"
    events = spark.read.parquet(f"{sf_dir}/events.parquet")

    def lake(run: int) -> jobs.LakeConfig:
        return jobs.LakeConfig(base_uri=f"{root}/lake{run}")

    def land(run: int):
        feed = change_feed(events)
        jobs.run_kafka_to_bronze(spark, lake(run), feed, ingested_at=F.col("ingested_at"))

    def serve(run: int):
        tables = jobs.read_gold_tables(spark, lake(run))
        data = serving.load_dashboard_data(tables)
        views = serving.dashboard_views(
            data, catalog.SERVING_START, catalog.SERVING_END, catalog.TOP_N,
            catalog.RECENT_ROWS, catalog.STALE_AFTER_MINUTES, AS_OF,
        )
        for view in views.values():
            view.collect()  # each view is one row or a capped top-n

    def e2e(name: str):
        def run(_run: int):
            catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return run

    steps = {
        "land_bronze": land,
        "bronze_to_silver": lambda r: jobs.run_bronze_to_silver(spark, lake(r), as_of=AS_OF),
        "silver_to_gold": lambda r: jobs.run_silver_to_gold(spark, lake(r)),
        "lake_checks": lambda r: jobs.run_checks(spark, lake(r), raise_on_failure=False),
        "dashboard_check": lambda r: jobs.run_dashboard_check(spark, lake(r)),
        "serving_views": serve,
        "q_window_e2e": e2e("agg_events_by_window"),
        "q_top_pages_e2e": e2e("agg_top_pages"),
    }

    # Warm-up: JIT and code generation on a throwaway lake.
    for name, step in steps.items():
        step(-1)

    timings: dict[str, list[float]] = {name: [] for name in steps}
    for r in range(repeat):
        for name, step in steps.items():
            t0 = time.perf_counter()
            step(r)
            timings[name].append(time.perf_counter() - t0)

    medians = {name: round(statistics.median(v), 3) for name, v in timings.items()}
    print(
        json.dumps(
            {
                "metric": "lakehouse_total_median_sec",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": _sf_of(sf_dir),
                "cpus": cpus,
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
