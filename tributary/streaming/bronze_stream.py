"""Continuous Bronze ingest with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tributary.schemas import BRONZE_PARTITIONS, DEFAULT_TRIGGER_INTERVAL
from tributary.sources.kafka import to_bronze
from tributary.sources.lake import partition_columns


def start_bronze_stream(
    kafka_stream: DataFrame,
    output_path: str,
    checkpoint_path: str,
    trigger_interval: str | None = DEFAULT_TRIGGER_INTERVAL,
    available_now: bool = False,
    output_format: str = "parquet",
    partition_by: str | Sequence[str] | None = BRONZE_PARTITIONS,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append raw records to Bronze; offsets and commits live in the checkpoint.

    Restarting with the same ``checkpoint_path`` resumes after the last
    committed batch, so nothing is landed twice (file sink is exactly-once).
    ``available_now`` processes the backlog and stops (backfill / tests);
    otherwise a batch starts every ``trigger_interval``.
    """
    bronze = to_bronze(kafka_stream)
    writer = (
        bronze.writeStream.format(output_format)
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=trigger_interval or DEFAULT_TRIGGER_INTERVAL
    )
    columns = partition_columns(partition_by)
    if columns:
        writer = writer.partitionBy(*columns)
    return writer.start()
