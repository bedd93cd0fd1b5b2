"""Kafka -> Bronze in planned offset ranges.

A ledger under ``bronze_offsets_path`` says, per topic and partition, the first
offset that no batch has taken. A batch opens its range in the ledger, reads
from there to the newest offset, lands the records, and closes the range with
the highest offset that the write itself has seen: nothing is read twice, and
neither the topic nor Bronze is read from the start.

A range that was opened and not closed (a run that stopped) is taken again by the
next batch, which then leaves out what Bronze holds of it. The first batch over
an older Bronze does the same from the topic's start, once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tributary.plans.jobs import LakeConfig, landed_from, lowest_offsets
from tributary.schemas import BRONZE_KEY
from tributary.sinks.manifest import Manifest
from tributary.sources.kafka import to_bronze
from tributary.sources.lake import BRONZE_BATCH, has_data_files, read_bronze

#: ``startingOffsets`` of a partition that no batch has read: the earliest.
EARLIEST = -2

Offsets = dict[str, dict[str, int]]
#: ``startingOffsets`` and ``endingOffsets`` to the records of that range.
Reader = Callable[[str, str], DataFrame]


@dataclass
class Landing:
    """Where a batch landed, from which offsets it read, and the next ones."""

    path: str
    starting: Offsets
    following: Offsets


def starting_offsets(following: Mapping[str, Mapping[str, int]], topics: Mapping[str, int]) -> Offsets:
    """Next offset of every partition (``topics``: number of partitions of
    each); a partition that the ledger doesn't know starts at its earliest."""
    return {
        topic: {str(p): following.get(topic, {}).get(str(p), EARLIEST) for p in range(partitions)}
        for topic, partitions in topics.items()
    }


def from_offsets(starting: Offsets) -> Column:
    """Is a Kafka record in the range? Simple comparisons, so files in the
    Kafka layout skip what lies below; partitions not listed count whole."""
    topic, partition, offset = F.col("topic"), F.col("partition"), F.col("offset")
    found = ~topic.isin([*starting])
    for name, own in starting.items():
        taken = ~partition.isin([int(p) for p in own])
        for number, first in own.items():
            taken = taken | ((partition == int(number)) & (offset >= first))
        found = found | ((topic == name) & taken)
    return found


def _highest(starting: Offsets) -> tuple[list[Column], list[tuple[str, str, str]]]:
    """Metrics of a write: highest offset per listed partition, and how many
    records belong to others."""
    topic, partition, offset = F.col("kafka_topic"), F.col("kafka_partition"), F.col("kafka_offset")
    metrics, names, listed = [], [], F.lit(False)
    for name, own in starting.items():
        for number in own:
            mine = (topic == name) & (partition == int(number))
            listed = listed | mine
            metrics.append(F.max(F.when(mine, offset)).alias(f"m{len(names)}"))
            names.append((f"m{len(names)}", name, number))
    return [*metrics, F.count_if(~listed).alias("others")], names


def land_new_offsets(
    spark: SparkSession, config: LakeConfig, read: Reader, topics: Mapping[str, int], ingested_at=None
) -> Landing:
    """Land the records behind the ledger's offsets.

    ``read`` gets the two offset options of the Kafka source, for example
    ``lambda start, end: read_kafka(spark, servers, topic, start, end)``;
    ``topics`` is the number of partitions of each topic, which the source
    wants listed in full.
    """
    ledger = Manifest(spark, config.path("bronze_offsets"))
    before = ledger.current()
    following: Offsets = (before or {}).get("following", {})
    starting = starting_offsets(following, topics)
    unsure = before["open"] if before else has_data_files(spark, config.path("bronze"))
    ledger.publish({"following": following, "open": True})

    bronze = to_bronze(read(json.dumps(starting), "latest").where(from_offsets(starting)), ingested_at)
    held = None
    if unsure and has_data_files(spark, config.path("bronze")):
        landed = read_bronze(spark, config.path("bronze"), config.format_of("bronze"))
        held = landed_from(landed, lowest_offsets(bronze))
        bronze = bronze.join(held, list(BRONZE_KEY), "left_anti")
    metrics, names = _highest(starting)
    observation = Observation("offsets")
    path = config.writer("bronze", BRONZE_BATCH).write(bronze, observe=(observation, metrics))
    seen = observation.get
    highest = [(topic, number, seen.get(m)) for m, topic, number in names]
    if held is not None or seen.get("others"):
        # What a stopped run had landed, and partitions nobody listed, count too.
        landed = read_bronze(spark, config.path("bronze"), config.format_of("bronze"))
        rows = landed.groupBy("kafka_topic", "kafka_partition").agg(F.max("kafka_offset").alias("highest")).collect()
        highest += [(r.kafka_topic, str(r.kafka_partition), r.highest) for r in rows]  # one per Kafka partition
    closed = {topic: dict(own) for topic, own in following.items()}
    for topic, number, offset in highest:
        if offset is not None:
            own = closed.setdefault(topic, {})
            own[number] = max(own.get(number, EARLIEST), offset + 1)
    ledger.publish({"following": closed, "open": False})
    return Landing(path, starting, closed)
