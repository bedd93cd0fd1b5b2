"""Command line for ``spark-submit``: one sub-command per job.

    spark-submit -m tributary.plans.cli silver --base-uri abfss://… --lookback-days 3
    python -m tributary.plans.cli gold --base-uri file:/data/lake

Sub-commands: ``bronze`` (Kafka -> Bronze, ``--stream`` for continuous),
``topic-schema`` (schema of a topic's records), ``silver`` (Bronze -> Silver +
quarantine), ``gold`` (Silver -> Gold),
``checks``, ``dashboard-check``, ``scheduled`` (silver, gold, checks without
Bronze, dashboard check) and ``preview`` (schema and first rows of a layer).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from tributary.operators.checks import raise_on_failures
from tributary.plans import jobs
from tributary.plans.check_state import lake_metrics_by_state
from tributary.schemas import DEFAULT_LATE_ARRIVAL_DAYS
from tributary.session import configure


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tributary", description=__doc__.splitlines()[0])
    parser.add_argument("--base-uri", required=True, help="lake root URI (file:, abfss:, s3a:, …)")
    parser.add_argument("--format", default="parquet", help="layer file format")
    sub = parser.add_subparsers(dest="job", required=True)

    bronze = sub.add_parser("bronze", help="Kafka -> Bronze")
    bronze.add_argument("--bootstrap-servers", required=True)
    bronze.add_argument("--topic", required=True)
    bronze.add_argument("--stream", action="store_true")
    bronze.add_argument("--starting-offsets", default=None)
    bronze.add_argument("--trigger-interval", default=None)
    bronze.add_argument("--available-now", action="store_true")
    bronze.add_argument("--only-new-offsets", action="store_true")

    for name in ("silver", "scheduled"):
        p = sub.add_parser(name, help="Bronze -> Silver + quarantine" if name == "silver" else
                           "silver, gold, checks, dashboard check")
        p.add_argument("--late-arrival-days", type=int, default=DEFAULT_LATE_ARRIVAL_DAYS)
        p.add_argument("--lookback-days", type=int, default=None)
        p.add_argument("--strict-quality", action="store_true")
        if name == "silver":
            p.add_argument("--backfill-start-date", type=_date, default=None)
            p.add_argument("--backfill-end-date", type=_date, default=None)
        else:
            p.add_argument("--min-fact-rows", type=int, default=1)

    topic = sub.add_parser("topic-schema", help="schema of a topic's records (bounded scan)")
    topic.add_argument("--bootstrap-servers", required=True)
    topic.add_argument("--topic", required=True)

    sub.add_parser("gold", help="Silver -> Gold")
    checks = sub.add_parser("checks", help="layer checks")
    checks.add_argument("--skip-bronze", action="store_true")
    checks.add_argument("--by-state", action="store_true", help="read only the dates that changed since the last such run")
    dash = sub.add_parser("dashboard-check", help="serving tables ready")
    dash.add_argument("--min-fact-rows", type=int, default=1)
    preview = sub.add_parser("preview", help="schema and first rows of a layer or Gold table")
    preview.add_argument("layer", choices=["bronze", "silver", "quarantine", "gold"])
    preview.add_argument("--table", default=None)
    preview.add_argument("--limit", type=int, default=5)
    return parser


def run(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = build_parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName(f"tributary-{args.job}").getOrCreate())
    config = jobs.LakeConfig(base_uri=args.base_uri, layer_format=args.format)
    if args.job == "bronze":
        from tributary.sources.kafka import read_kafka, read_kafka_stream

        if args.stream:
            stream = read_kafka_stream(spark, args.bootstrap_servers, args.topic, args.starting_offsets)
            query = jobs.start_kafka_to_bronze_stream(
                spark, config, stream, args.trigger_interval, args.available_now
            )
            query.awaitTermination()
            return query
        kafka = read_kafka(spark, args.bootstrap_servers, args.topic, args.starting_offsets or "earliest")
        return jobs.run_kafka_to_bronze(spark, config, kafka, args.only_new_offsets)
    if args.job == "topic-schema":
        from tributary.sources.kafka import read_kafka

        kafka = read_kafka(spark, args.bootstrap_servers, args.topic)
        kafka.printSchema()
        return kafka.schema
    if args.job == "silver":
        return jobs.run_bronze_to_silver(
            spark, config, args.late_arrival_days, args.backfill_start_date,
            args.backfill_end_date, args.lookback_days, args.strict_quality,
        )
    if args.job == "gold":
        return jobs.run_silver_to_gold(spark, config)
    if args.job == "checks":
        if args.by_state:
            rows = list(map(tuple, lake_metrics_by_state(spark, config, args.skip_bronze)[0].collect()))
        else:
            rows = jobs.run_checks(spark, config, skip_bronze=args.skip_bronze, raise_on_failure=False)
        for check, metric, value, failed in rows:
            print(f"{check}.{metric}: {value}{'  FAILED' if failed else ''}")
        return raise_on_failures(rows)
    if args.job == "dashboard-check":
        return jobs.run_dashboard_check(spark, config, args.min_fact_rows)
    if args.job == "scheduled":
        return jobs.run_scheduled(
            spark, config, args.late_arrival_days, args.lookback_days, args.strict_quality,
            args.min_fact_rows,
        )
    if args.job == "preview":
        from tributary.sinks.lake import preview
        from tributary.sources.lake import read_layer

        path = config.path(args.layer, args.table)
        return preview(read_layer(spark, path, config.layer_format), args.limit)
    raise SystemExit(f"unknown job {args.job}")


if __name__ == "__main__":
    run(sys.argv[1:])
