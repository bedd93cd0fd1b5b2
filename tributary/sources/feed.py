"""Change feed in the Kafka column layout, derived from the ``events`` table.

Every record is a deterministic function of ``event_id``, ``user_id``,
``event_type`` and ``ts``, so test oracles can be written directly on
``events``. ``n = event_id`` and ``d = n % 100`` choose the edge case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: the feed recipe -------------------------------------------
FEED_TOPIC = "changes"
FEED_PARTITIONS = 3
LATE_CASE_EXTRA_DAYS = 5
# d -> edge case:
#   0 null value        1 three spaces      2 "not json"        3 "{}"
#   4 wiki null         5 title two spaces  6 dt "bad", no Unix time
#   7 dt "bad"          8 dt null           9 title "<b></b>"
#  10 late arrival     11 repeats meta.id of the previous event
# -----------------------------------------------------------------------------


def _payload():
    """The change event as a struct (before JSON encoding)."""
    n = F.col("event_id")
    d = n % 100
    user_id = F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    site = F.concat(F.lit("w"), (user_id % 5).cast("string"), F.lit(".example.org"))
    page_no = (n % 50).cast("string")
    comment_no = (n % 10).cast("string")

    title = (
        F.when(d == 5, F.lit("  "))
        .when(d == 9, F.lit("<b></b>"))
        .otherwise(F.concat(F.lit("<i>Page "), page_no, F.lit("</i> &amp; more")))
    )
    unix_seconds = F.when(d != 6, F.unix_seconds(ts))
    dt_text = F.when(d.isin(6, 7), F.lit("bad")).when(
        d != 8, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    meta_id = F.concat(
        F.lit("m-"), F.when(d == 11, n - 1).otherwise(n).cast("string")
    )
    payload = F.struct(
        n.alias("id"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("type"),
        (n % 4).alias("namespace"),
        title.alias("title"),
        F.concat(F.lit("https://"), site, F.lit("/"), page_no).alias("title_url"),
        F.concat(F.lit("edit&nbsp;"), comment_no).alias("comment"),
        F.when(
            n % 2 == 0, F.concat(F.lit('<a href="x">edit</a>  '), comment_no)
        ).alias("parsedcomment"),
        unix_seconds.alias("timestamp"),
        F.concat(F.lit("user"), user_id.cast("string")).alias("user"),
        F.when(n % 13 != 0, user_id % 7 == 0).alias("bot"),
        site.alias("server_name"),
        F.when(d != 4, F.concat(F.lit("Wiki"), (user_id % 5).cast("string"))).alias(
            "wiki"
        ),
        F.struct(
            meta_id.alias("id"),
            site.alias("domain"),
            F.lit(FEED_TOPIC).alias("stream"),
            dt_text.alias("dt"),
        ).alias("meta"),
    )
    return payload


def feed_events(events: DataFrame) -> DataFrame:
    """``event_id``, the edge case ``d`` and the change event struct ``event``."""
    return events.select(
        "event_id", (F.col("event_id") % 100).alias("d"), "ts", _payload().alias("event")
    )


def change_feed(events: DataFrame) -> DataFrame:
    """``events`` -> Kafka records plus the ``ingested_at`` time to land them."""
    n = F.col("event_id")
    d = F.col("d")
    ts = F.col("ts").cast("timestamp")
    payload = F.col("event")
    value = (
        F.when(d == 0, F.lit(None).cast("string"))
        .when(d == 1, F.lit("   "))
        .when(d == 2, F.lit("not json"))
        .when(d == 3, F.lit("{}"))
        .otherwise(F.to_json(payload, {"ignoreNullFields": "false"}))
    )
    ingested_at = ts + F.expr("INTERVAL 1 MINUTE") + F.when(
        d == 10, F.expr(f"INTERVAL {LATE_CASE_EXTRA_DAYS} DAYS")
    ).otherwise(F.expr("INTERVAL 0 DAYS"))
    return feed_events(events).select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(FEED_TOPIC).alias("topic"),
        (n % FEED_PARTITIONS).cast("int").alias("partition"),
        F.expr(f"event_id div {FEED_PARTITIONS}").alias("offset"),
        ts.alias("timestamp"),
        ingested_at.alias("ingested_at"),
    )
