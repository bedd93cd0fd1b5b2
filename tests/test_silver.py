import datetime as dt

from tests.conftest import event, kafka_frame
from tributary.operators.quality import prepare_for_quality_checks, split_valid_and_quarantine
from tributary.operators.silver import transform_to_silver
from tributary.schemas import QUALITY_COLUMNS, SILVER_COLUMNS
from tributary.sources.kafka import parse_raw_messages, to_bronze

INGEST = dt.datetime(2024, 1, 5, 13, 0, 0)


def silver_of(spark, values, through_quality=True):
    loaded = parse_raw_messages(to_bronze(kafka_frame(spark, values), ingested_at=INGEST))
    if through_quality:
        valid, _ = split_valid_and_quarantine(prepare_for_quality_checks(loaded, 2, INGEST))
        return transform_to_silver(valid)
    return transform_to_silver(loaded)


def test_reference_examples(spark):
    # valid event kept; null wiki rejected; ids dup, dup, uniq -> 2 rows
    assert silver_of(spark, [event()], False).count() == 1
    assert silver_of(spark, [event(wiki=None)], False).count() == 0
    dedup = silver_of(spark, [event(meta={"id": "dup"}), event(meta={"id": "dup"}),
                              event(meta={"id": "uniq"})], False)
    assert dedup.count() == 2


def test_dedup_keeps_lowest_kafka_position(spark):
    values = [
        (event(id=3, meta={"id": "same"}), 2, 1),
        (event(id=1, meta={"id": "same"}), 0, 9),
        (event(id=2, meta={"id": "same"}), 1, 0),
    ]
    rows = silver_of(spark, values).collect()
    assert [(r["event_id"], r["kafka_partition"], r["kafka_offset"]) for r in rows] == [(1, 0, 9)]
    # shuffled input and a rerun give the same survivor
    again = silver_of(spark, list(reversed(values))).collect()
    assert [r["event_id"] for r in again] == [1]


def test_cleaning_rules(spark):
    values = [
        event(id=1, meta={"id": "a"}, title="<b></b>", type="  EDIT ", wiki=" EnWiki "),
        event(id=2, meta={"id": "b"}, parsedcomment="", comment="x", bot=None),
        event(id=3, meta={"id": "c"}, parsedcomment=None, comment="<i>hi</i>&nbsp;there"),
    ]
    rows = {r["event_id"]: r for r in silver_of(spark, values).collect()}
    assert rows[1]["page_title"] is None
    assert (rows[1]["event_type"], rows[1]["wiki"]) == ("edit", "enwiki")
    assert rows[2]["comment"] is None
    assert rows[2]["is_bot"] is False and rows[2]["is_minor"] is False
    assert rows[3]["comment"] == "hi there"


def test_silver_columns(spark):
    df = silver_of(spark, [event()])
    assert df.columns == list(SILVER_COLUMNS) + list(QUALITY_COLUMNS)
    assert silver_of(spark, [event()], False).columns == list(SILVER_COLUMNS)
