import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tributary.functions import (
    blank_to_null,
    calendar_parts,
    clean_text,
    date_key,
    event_time,
    message_key,
    null_safe_long,
    safe_percent,
    stable_key,
)
from tributary.plans.catalog import queries


def one(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_clean_text_cases(spark):
    texts = [
        "a < b and c > d",
        "&amp;quot;",
        "&lt;b&gt;",
        "x y",
        None,
        "<i>Page 1</i> &amp; more",
        "edit&nbsp;3",
        "  many \t\n spaces  ",
        "it&#39;s &apos;q&apos; &quot;z&quot; &#160;",
    ]
    got = one(spark, clean_text("t"), [(t,) for t in texts], "t string")
    assert got == [
        "a d",
        "&quot;",
        "&lt;b&gt;",
        "x y",
        "",
        "Page 1 & more",
        "edit 3",
        "many spaces",
        "it's 'q' \"z\"",
    ]


def test_blank_to_null(spark):
    got = one(spark, blank_to_null("t"), [("<b></b>",), ("&nbsp;",), ("  x ",), (None,)], "t string")
    assert got == [None, None, "x", None]


def test_stable_key_matches_sha256_of_joined_parts(spark):
    got = spark.createDataFrame([("a", None, True)], "x string, y string, z boolean").select(
        stable_key("x", "y", "z")
    ).first()[0]
    assert got == hashlib.sha256(b"a||__null__||true").hexdigest()


def test_message_key_reference_examples(spark):
    rows = [("enwiki", "Test", "m1"), ("enwiki", None, "m1"), (None, None, None),
            ("", "Test", "m2"), (None, "T", "")]
    got = one(spark, message_key("wiki", "title", "meta_id"), rows,
              "wiki string, title string, meta_id string")
    assert got == ["enwiki:Test", "enwiki", None, "m2", None]


def test_event_time_fallbacks(spark):
    rows = [
        ("2024-01-05T12:00:00Z", 0),
        ("bad", 1704456000),
        ("bad", None),
        (None, 1704456000),
        (None, 1704456000000),  # milliseconds: kept as a far-future time
    ]
    got = one(spark, event_time("d", "u"), rows[:4], "d string, u long")
    assert got[0] == dt.datetime(2024, 1, 5, 12, 0, 0)
    assert got[1] == dt.datetime(2024, 1, 5, 12, 0, 0)
    assert got[2] is None
    assert got[3] == dt.datetime(2024, 1, 5, 12, 0, 0)
    year = spark.createDataFrame(rows[4:], "d string, u long").select(F.year(event_time("d", "u"))).first()[0]
    assert year > 50_000  # Unix milliseconds read as seconds: kept, far future


def test_times_without_a_date_key_are_unreadable(spark):
    rows = [(None, 7_000_000_000_000), (None, 9_223_372_036_855), (None, -70_000_000_000), ("0001-01-01T00:00:00Z", 0)]
    got = one(spark, event_time("d", "u").cast("string"), rows, "d string, u long")
    assert got == [None, None, None, "0001-01-01 00:00:00"]
    keys = spark.sql(
        "select make_date(214748, 12, 31) d union all select make_date(1, 1, 1) union all select make_date(214749, 1, 1) "
        "union all select make_date(0, 5, 5) union all select cast(null as date)"
    ).select(date_key("d").alias("k"))
    assert sorted((r.k for r in keys.collect()), key=str) == sorted([2147481231, 10101, None, None, None], key=str)


@pytest.mark.parametrize("run", ["<b>", " ", "&nbsp;", "\n<i></i>&#160;", "&quot;", "x<y "])
def test_clean_text_has_no_length_limit(spark, run):
    n = 1_000_000 if run != "x<y " else 2_000
    df = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(run), n), F.lit("z>")).alias("t"))
    got = df.select(clean_text("t").alias("c")).first().c
    want = {"&quot;": "a" + '"' * n + "z>", "x<y ": "ax", "<b>": "a z>", " ": "a z>", "&nbsp;": "a z>"}
    assert got == want.get(run, "a z>")


def test_clean_text_is_its_steps_one_after_another(spark):
    steps = [(r"<[^>]*>", " "), (r"&nbsp;|&#160;", " "), (r"&quot;", '"'), (r"&#39;|&apos;", "'"), (r"&amp;", "&"),
             (r"[ \t\n\x0b\f\r]+", " ")]
    draw = random.Random(5)
    pieces = ["<", ">", "<b>", "</i >", "&", "amp;", "&amp;", "nbsp;", "&nbsp;", "&#160;", "&#39;", "&quot;", "&apos;",
              " ", "\t\n", "\u00a0", "x", "é", "$1", "\\"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(1, 30))) for _ in range(3000)]
    want = []
    for text in texts:
        for pattern, plain in steps:
            text = re.sub(pattern, lambda _, plain=plain: plain, text)
        want.append(text.strip(" "))
    assert one(spark, clean_text("t"), [(t,) for t in texts], "t string") == want


def test_clean_text_takes_one_pass_of_patterns(spark, tmp_path, capsys):
    spark.createDataFrame([(1, "<p>x</p>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    queries()["clean_text_long"](spark, str(tmp_path)).explain("extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("regexp_replace(") == 2  # of a text with marks, or of one without
    assert not re.search(r"regexp_replace\((replace|regexp_replace|CASE)", optimized)


@pytest.mark.parametrize("text", ["<b><i", "<<b>>", "&nbsp;<b>&#160;\t</b> ", "&nb<b>sp;", "&amp;nbsp;&nbsp;", "&nbsp", "&#16&nbsp;0;", "<\n>", "a<b", ""])
def test_clean_text_where_gaps_meet(spark, text):
    want = re.sub("[ \t\n]+", " ", re.sub("&nbsp;|&#160;", " ", re.sub("<[^>]*>", " ", text))).replace("&amp;", "&").strip(" ")
    assert one(spark, clean_text("t"), [(text,)], "t string") == [want]


def test_long_texts_are_dealt_to_all_cores(spark, tmp_path):
    pages = spark.createDataFrame([(i % 2 or None, "<p>x</p>") for i in range(64)], "page_id long, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    dealt = queries()["clean_text_long"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) >= spark.sparkContext.defaultParallelism and sum(r[1] for r in dealt) == 64


def test_event_time_keeps_repeated_dst_hour(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.createDataFrame([(None, 1762065000)], "d string, u long").select(
            F.unix_seconds(event_time("d", "u"))
        ).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 1762065000


def test_date_key_and_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    row = df.select(date_key("d").alias("k"), *[c.alias(n) for n, c in calendar_parts("d").items()]).first()
    assert row["k"] == 20240107
    assert (row["year"], row["quarter"], row["month"], row["day"], row["day_of_week"]) == (2024, 1, 1, 7, 1)


def test_safe_percent_and_null_safe(spark):
    rows = [(5, 10), (0, 0), (None, 3)]
    got = one(spark, safe_percent("a", "b"), rows, "a long, b long")
    assert got == [50.0, 0.0, None]
    assert one(spark, null_safe_long("a"), rows, "a long, b long") == [5, 0, 0]
