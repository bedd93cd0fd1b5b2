"""Layer writers."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation

from tributary.sources.lake import partition_columns

T = TypeVar("T")


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "append",
    output_format: str = "parquet",
    partition_by: str | Sequence[str] | None = None,
    overwrite_partitions: str | None = None,
    rebalance: bool = True,
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> str:
    """Write one layer or table folder and return its path (K1).

    * ``overwrite_partitions="dynamic"`` replaces only the partitions present
      in ``df`` (set per write, not per session) (K11).
    * With partition columns the rows are first rebalanced on them (a
      ``REBALANCE`` hint that adaptive execution sizes and splits when one
      value is hot), so each task writes few, large files per partition
      instead of every task writing a file into every partition.
    * ``observe`` attaches metrics after the rebalance, in the stage that
      writes: updates from result tasks are applied once per partition even
      when a lost executor forces tasks to rerun, which would not hold for an
      observation placed in a map stage below the shuffle.
    """
    columns = partition_columns(partition_by)
    if columns and rebalance:
        df = df.hint("rebalance", *columns)
    if observe is not None:
        observation, metrics = observe
        df = df.observe(observation, *metrics)
    writer = df.write.mode(mode).format(output_format)
    if overwrite_partitions:
        writer = writer.option("partitionOverwriteMode", overwrite_partitions)
    if columns:
        writer = writer.partitionBy(*columns)
    try:
        writer.save(path)
    except Exception as exc:
        if any(marker in str(exc) for marker in _MISSING_CONTAINER_MARKERS):
            raise MissingContainerError(
                f"The storage container for {path} does not exist. "
                "Create it in the storage account first, then rerun the job."
            ) from None
        raise
    return path


# Error texts of object stores whose container/bucket is missing.
_MISSING_CONTAINER_MARKERS = (
    "FilesystemNotFound",
    "specified filesystem does not exist",
    "NoSuchBucket",
)


class MissingContainerError(RuntimeError):
    """The target container/bucket of a write does not exist."""


@dataclass(frozen=True)
class LayerWriter:
    """Settings of one layer: where, in which format, how, partitioned by what."""

    path: str
    output_format: str = "parquet"
    mode: str = "append"
    partition_by: str = ""
    overwrite_partitions: str | None = None

    def write(
        self,
        df: DataFrame,
        child: str | None = None,
        partition_by: str | None = None,
        observe: tuple[Observation, Sequence[Column]] | None = None,
        rebalance: bool = True,
    ) -> str:
        path = self.path.rstrip("/") + (f"/{child.strip('/')}" if child else "")
        return write_layer(
            df,
            path,
            mode=self.mode,
            output_format=self.output_format,
            partition_by=self.partition_by if partition_by is None else partition_by,
            overwrite_partitions=self.overwrite_partitions,
            rebalance=rebalance,
            observe=observe,
        )


def write_tables(
    writer: LayerWriter,
    tables: Mapping[str, DataFrame],
    partitions: Mapping[str, str],
    parallel: int = 8,
    dealt: Collection[str] = (),
) -> dict[str, str]:
    """Each table to its own folder with its own partition columns (K6).

    The writes are independent jobs, so they are submitted from a small
    thread pool: Spark schedules their stages side by side, and many small
    jobs no longer leave most executor slots idle while each one finishes.
    Frames persisted upstream are computed once (concurrent tasks wait for the
    block being cached instead of computing it twice).

    Tables named in ``dealt`` come in tasks of few partition values already
    (read from a layer with the same partitions) and are not rebalanced.
    """
    return run_concurrently(
        {
            name: (
                lambda df=df, name=name: writer.write(
                    df, child=name, partition_by=partitions.get(name, ""), rebalance=name not in dealt
                )
            )
            for name, df in tables.items()
        },
        parallel,
    )


def run_concurrently(actions: Mapping[str, Callable[[], T]], parallel: int = 8) -> dict[str, T]:
    """Run independent Spark actions from a thread pool; re-raise the first error."""
    if parallel <= 1 or len(actions) <= 1:
        return {name: action() for name, action in actions.items()}
    with ThreadPoolExecutor(max_workers=min(parallel, len(actions))) as pool:
        futures = {name: pool.submit(action) for name, action in actions.items()}
        return {name: future.result() for name, future in futures.items()}


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header row (K9); a folder of part files, written by executors."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


#: Dashboard views that the page offers as CSV files (K9).
DASHBOARD_EXPORTS = ("events_by_date", "event_types", "top_pages", "recent_events")


def export_dashboard(views: Mapping[str, DataFrame], base_path: str, mode: str = "overwrite") -> dict[str, str]:
    """The four CSV exports of the dashboard (K9): the date-filtered series, event
    types and top pages cut to the chosen number, and the recent events shown.

    ``views`` is the result of ``serving.dashboard_views``; each export is a
    folder named after it below ``base_path``."""
    return {
        name: export_csv(views[name if name in views else f"{name}_chart"], f"{base_path.rstrip('/')}/{name}", mode)
        for name in DASHBOARD_EXPORTS
    }


def preview_frame(df: DataFrame, rows: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The first rows (K10), in the order of ``by`` where it is given."""
    return (df.orderBy(*by) if by else df).limit(rows)


def schema_frame(df: DataFrame) -> DataFrame:
    """A frame's columns with their types, in order (S3)."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(fields, "position int, column string, type string")


def preview(df: DataFrame, rows: int = 5) -> None:
    """Schema and the first rows, untruncated."""
    df.printSchema()
    preview_frame(df, rows).show(truncate=False)
