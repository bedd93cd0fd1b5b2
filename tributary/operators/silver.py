"""Silver clean-up and deterministic deduplication."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import blank_to_null, normalise
from tributary.functions.time import event_time
from tributary.schemas import BRONZE_KEY, QUALITY_COLUMNS, SILVER_COLUMNS

STRUCTURAL_COLUMNS = ("event_id", "meta_id", "event_type", "wiki", "page_title")
NORMALISED_COLUMNS = ("event_type", "wiki", "domain", "stream_name", "server_name")
BLANKABLE_COLUMNS = ("page_title", "page_url", "event_user")
FLAG_COLUMNS = ("is_bot", "is_minor", "is_patrolled")


def keep_one_per_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str] = BRONZE_KEY
) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple survives.

    Written as ``min(struct(order…, rest…))`` per key rather than a window:
    the aggregate combines map-side, so a key repeated across a third of the
    input reaches the shuffle as one row per map task, never as one giant
    group. ``order`` must be unique per row for a deterministic survivor.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


#: Repeated keys that travel to every task; beyond, all rows are grouped.
MOST_REPEATED = 500_000


@contextmanager
def one_per_repeated_key(
    rows: DataFrame, key: str, by: Sequence[str] = (), most: int = MOST_REPEATED
) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``keep_one_per_key`` for ``rows`` that are stored or persisted, so cheap
    to read again, and for parts of them: the same rows, but only those whose
    key repeats are sorted and sent.

    The repeated keys (null is one) are counted on the key column alone, and are
    held until the block ends. All other rows stay in the tasks that read them;
    the deduplicated ones are rebalanced on ``by`` where that is given.
    """
    repeated = rows.groupBy(key).agg(F.count("*").alias("_rows")).where("_rows > 1")
    repeated = repeated.select(F.col(key).alias("_repeated")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = repeated.count()

        def sent(df: DataFrame) -> DataFrame:
            kept = keep_one_per_key(df, key)
            return kept.hint("rebalance", *by) if by else kept

        def keep(df: DataFrame, own_key: str) -> DataFrame:
            if own_key != key:
                raise ValueError(f"The repeated values are those of {key}, not of {own_key}.")
            if not found:
                return df
            if found > most:
                return sent(df)
            again, same = F.broadcast(repeated), F.col(key).eqNullSafe(F.col("_repeated"))
            return df.join(again, same, "left_anti").unionByName(sent(df.join(again, same, "left_semi")))

        yield keep
    finally:
        repeated.unpersist()


def structural_filter(df: DataFrame) -> DataFrame:
    """Drop rows whose identifying fields did not parse."""
    return df.dropna(how="any", subset=list(STRUCTURAL_COLUMNS))


def clean_events(df: DataFrame) -> DataFrame:
    """C9, P2, C10, C5-C8 on deduplicated rows."""
    timed = df.withColumn(
        "event_datetime", event_time("event_datetime", "event_unix_timestamp")
    ).where(F.col("event_datetime").isNotNull())
    changes = {"event_date": F.to_date("event_datetime")}
    changes.update({c: normalise(c) for c in NORMALISED_COLUMNS})
    changes.update({c: blank_to_null(c) for c in BLANKABLE_COLUMNS})
    changes["comment"] = blank_to_null(F.coalesce("parsed_comment", "comment"))
    changes.update({c: F.coalesce(F.col(c), F.lit(False)) for c in FLAG_COLUMNS})
    return timed.withColumns(changes)


# Columns the Silver steps read (besides the quality columns that exist).
SILVER_INPUT_COLUMNS = (
    "event_id", "meta_id", "event_type", "event_datetime", "event_unix_timestamp", "wiki",
    "domain", "stream_name", "namespace", "page_title", "page_url", "event_user", "is_bot",
    "is_minor", "is_patrolled", "server_name", "comment", "parsed_comment",
    "bronze_ingested_at", "source_system", "message_key", "kafka_topic", "kafka_partition",
    "kafka_offset", "kafka_timestamp",
)


def silver_inputs(df: DataFrame) -> DataFrame:
    """Keep only what Silver reads, before the dedup carries whole rows through
    its sort and shuffle (the raw message and error text are not needed)."""
    extra = [c for c in QUALITY_COLUMNS if c in df.columns]
    return df.select(*SILVER_INPUT_COLUMNS, *extra)


def silver_projection(df: DataFrame) -> DataFrame:
    """The 24 Silver columns plus the quality columns that exist."""
    extra = [c for c in QUALITY_COLUMNS if c in df.columns]
    return df.select(*SILVER_COLUMNS, *extra)


def transform_to_silver(
    loaded: DataFrame, one_per_key: Callable[[DataFrame, str], DataFrame] = keep_one_per_key
) -> DataFrame:
    """Structural filter -> dedup by meta_id -> clean -> project.

    Dedup comes before the time filter, as in the original order, and keeps
    the lowest (topic, partition, offset) so reruns give the same rows. One
    shuffle, on ``meta_id``; the output stays hash-partitioned on it. Of a
    persisted frame ``one_per_repeated_key`` gives the same rows and shuffles
    those with a repeated ``meta_id`` only.
    """
    deduped = one_per_key(silver_inputs(structural_filter(loaded)), "meta_id")
    return silver_projection(clean_events(deduped))
