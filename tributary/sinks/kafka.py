"""Publishing change events as Kafka records (K7, K8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.keys import message_key


def kafka_records(
    events: DataFrame, payload: str | Column = "event", keep: Sequence[str] = ()
) -> DataFrame:
    """``key`` = ``wiki:title`` (else wiki, else meta.id) and ``value`` = the
    event as JSON with nulls written out (K7, K8). Needs no broker."""
    event = F.col(payload) if isinstance(payload, str) else payload
    key = message_key(event["wiki"], event["title"], event["meta"]["id"])
    return events.select(
        *keep,
        key.alias("key"), F.to_json(event, {"ignoreNullFields": "false"}).alias("value")
    )


def write_kafka(
    records: DataFrame,
    bootstrap_servers: str,
    topic: str,
    options: Mapping[str, str] | None = None,
    output_format: str = "kafka",
) -> None:
    """Write ``key``/``value`` records to one topic (needs the Kafka connector)."""
    writer = (
        records.write.format(output_format)
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
    )
    for name, value in (options or {}).items():
        writer = writer.option(name, value)
    writer.save()
