import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import event, kafka_frame
from tributary.operators.quality import (
    apply_processing_window,
    prepare_for_quality_checks,
    split_valid_and_quarantine,
)
from tributary.sources.kafka import parse_raw_messages, to_bronze

INGEST = dt.datetime(2024, 1, 5, 13, 0, 0)


def prepared(spark, values, late_days=2, ingested_at=INGEST):
    bronze = to_bronze(kafka_frame(spark, values), ingested_at=ingested_at)
    return prepare_for_quality_checks(parse_raw_messages(bronze), late_days, as_of=dt.datetime(2024, 2, 1))


def categories(df):
    return [(r["quality_error_category"], r["missing_required_fields"])
            for r in df.orderBy("kafka_offset").collect()]


def test_raw_missing_and_parse_failures(spark):
    values = [None, "", "   ", "garbage", "{}", "[1]", "null", '{"id": 1, "wiki"', "\t"]
    got = [c for c, _ in categories(prepared(spark, values))]
    assert got == ["raw_message_missing"] * 3 + ["schema_parse_failed"] * 6


def test_wrong_type_only_nulls_that_field(spark):
    df = prepared(spark, [event(id="7")])
    row = df.first()
    assert row["event_id"] is None and row["meta_id"] == "abc"
    assert categories(df) == [("missing_required_field", "event_id")]


def test_missing_fields_listed_in_rule_order(spark):
    df = prepared(spark, [event(wiki=None, title="  ", namespace=None)])
    row = df.first()
    assert row["quality_error_category"] == "missing_required_field"
    assert row["missing_required_fields"] == "wiki,namespace,page_title"
    assert row["quality_error_reason"] == "wiki,namespace,page_title"


def test_timestamp_rules(spark):
    values = [
        event(meta={"dt": "bad"}, timestamp=None),
        event(meta={"dt": "bad"}),
        event(meta={"dt": None}),
        event(meta={"dt": ...}, timestamp=1704456000000),
    ]
    df = prepared(spark, values).orderBy("kafka_offset")
    # the millisecond row is year ~56000, beyond Python datetime: read its year in Spark
    rows = df.select(
        "quality_error_category",
        "missing_required_fields",
        F.when(F.col("kafka_offset") < 3, F.col("parsed_event_datetime")).alias("parsed_event_datetime"),
    ).collect()
    assert rows[0]["quality_error_category"] == "invalid_event_timestamp"
    assert rows[1]["quality_error_category"] is None
    assert rows[1]["parsed_event_datetime"] == dt.datetime(2024, 1, 5, 12, 0, 0)
    assert rows[2]["quality_error_category"] is None
    assert rows[3]["quality_error_category"] is None
    assert df.select(F.year("parsed_event_datetime")).collect()[3][0] > 50_000
    assert rows[0]["missing_required_fields"] == ""


def test_late_flag_is_strict(spark):
    base = dt.datetime(2024, 1, 5, 12, 0, 0)
    frames = []
    for lag in (2, 3, -1):
        frames.append(prepared(spark, [event()], ingested_at=base + dt.timedelta(days=lag)))
    got = [(f.first()["arrival_lag_days"], f.first()["is_late_arriving"]) for f in frames]
    assert got == [(2, False), (3, True), (-1, False)]


def test_split_is_a_partition_of_the_input(spark):
    values = [None, "garbage", event(), event(wiki=None), event(meta={"dt": "bad"}, timestamp=None)]
    df = prepared(spark, values)
    valid, rejected = split_valid_and_quarantine(df)
    assert valid.count() + rejected.count() == df.count() == len(values)
    assert valid.count() == 1


def test_processing_window_bounds_beat_lookback(spark):
    df = prepared(spark, [event()])
    inside = apply_processing_window(df, dt.date(2024, 1, 5), dt.date(2024, 1, 5), lookback_days=1,
                                     as_of=dt.datetime(2030, 1, 1))
    assert inside.count() == 1
    outside = apply_processing_window(df, "2024-01-06", None)
    assert outside.count() == 0
    looked_back = apply_processing_window(df, lookback_days=1, as_of=dt.datetime(2024, 1, 6))
    assert looked_back.count() == 1
    too_old = apply_processing_window(df, lookback_days=1, as_of=dt.datetime(2024, 1, 10))
    assert too_old.count() == 0


def test_bad_window_bound_fails_before_any_job(spark):
    df = prepared(spark, [event()])
    try:
        apply_processing_window(df, "2024-13-45")
    except ValueError as exc:
        assert "yyyy-mm-dd" in str(exc)
    else:
        raise AssertionError("expected ValueError")
