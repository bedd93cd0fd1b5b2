"""Which date of Silver holds a ``meta_id`` (W2, D1, K4): a stored index.

A windowed Bronze -> Silver run must leave out the keys that Silver holds outside
its window. The index keeps (meta_id, event_date, run) in Parquet files bucketed
by ``meta_id``; a run's rows are shuffled to the buckets and joined there, and the
stored side is neither sorted into an exchange nor read beyond its two columns.

A manifest says, for each Silver date, which files it held and which run has its
keys; entries of other runs don't count. Only dates whose files have changed
since are read from Silver and appended. After ``RUNS`` appends, or when every
date has changed, the index is written anew into a folder of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sinks.manifest import Manifest
from tributary.sources.dates import NULL_DATE, changed_dates, date_files, on_dates
from tributary.sources.lake import child_folders, delete_folder, read_layer

#: Appends before the index is written anew.
RUNS = 16
COLUMNS = "meta_id string, event_date date, run string"


class KeyIndex:
    """Index of ``key`` over a layer by event date; ``meta_id`` is the index's
    own name of the key."""

    def __init__(
        self, spark: SparkSession, path: str, silver_path: str, silver_format: str = "parquet", key: str = "meta_id"
    ) -> None:
        self.spark, self.key = spark, key
        self.path = path.rstrip("/")
        self.silver_path, self.silver_format = silver_path, silver_format
        self.manifest = Manifest(spark, f"{self.path}/manifest")

    @contextmanager
    def _table(self, folder: str, buckets: int) -> Iterator[str]:
        """The bucketed files as a table; the catalog's entry lasts as long as
        the block, the files stay."""
        location = f"{self.path}/keys/{folder}"
        name = f"tributary_keys_{hashlib.md5(location.encode()).hexdigest()}_{uuid.uuid4().hex[:8]}"
        self.spark.sql(
            f"CREATE TABLE {name} ({COLUMNS}) USING parquet CLUSTERED BY (meta_id) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _keys(self, dates: list[str], run: str) -> DataFrame:
        silver = read_layer(self.spark, self.silver_path, self.silver_format)
        return silver.where(on_dates(dates)).select(F.col(self.key).alias("meta_id"), "event_date", F.lit(run).alias("run"))

    def _valid(self, table: DataFrame, dates: dict[str, dict]) -> DataFrame:
        """Entries that the manifest names: a row per date is broadcast."""
        named = self.spark.createDataFrame(
            [(None if d == NULL_DATE else d, v["run"]) for d, v in dates.items()], "d string, r string"
        ).select(F.col("d").cast("date").alias("d"), "r")
        return table.join(F.broadcast(named), F.expr("event_date <=> d and run = r"), "left_semi")

    def refresh(self) -> dict | None:
        """Bring the index up to date with Silver's files; the manifest."""
        before = self.manifest.current()
        held = before["dates"] if before else {}
        found = date_files(self.spark, self.silver_path)
        changed, gone = changed_dates(found, held)
        if not changed and not gone:
            return before
        run = uuid.uuid4().hex
        same = {d: held[d] for d in held.keys() & found.keys() - set(changed)}
        anew = before is None or not same or before["appends"] >= RUNS
        folder = run if anew else before["folder"]
        # As many buckets as the session's exchanges have parts.
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200")) if anew else before["buckets"]
        with self._table(folder, buckets) as table:
            rows = self._keys(changed, run)
            if anew and same:
                with self._table(before["folder"], before["buckets"]) as old:
                    rows = rows.unionByName(self._valid(self.spark.table(old), same))
                    self._append(rows, table, buckets)
            else:
                self._append(rows, table, buckets)
        now = {
            "folder": folder, "buckets": buckets, "appends": 0 if anew else before["appends"] + 1,
            "dates": same | {d: {"files": found[d], "run": run} for d in changed},
        }
        self.manifest.publish(now)
        for other in set(child_folders(self.spark, f"{self.path}/keys")) - {folder, (before or {}).get("folder")}:
            delete_folder(self.spark, f"{self.path}/keys/{other}")
        return now

    def _append(self, rows: DataFrame, table: str, buckets: int) -> None:
        # One task per bucket, so each append adds one file to a bucket.
        rows.repartition(buckets, "meta_id").write.insertInto(table)

    @contextmanager
    def outside(self, dates: list[str]) -> Iterator[DataFrame | None]:
        """``meta_id`` of the rows that Silver holds outside ``dates`` (date
        folders), clustered by key; None if there are none."""
        now = self.refresh()
        others = {d: v for d, v in now["dates"].items() if d not in set(dates)} if now else {}
        if not others:
            yield None
            return
        with self._table(now["folder"], now["buckets"]) as table:
            yield self._valid(self.spark.table(table), others).select("meta_id")

    @contextmanager
    def counts(self) -> Iterator[DataFrame | None]:
        """(meta_id, n): rows of the layer per key, counted bucket by bucket
        without an exchange; None if the layer has no rows."""
        now = self.refresh()
        if not now or not now["dates"]:
            yield None
            return
        with self._table(now["folder"], now["buckets"]) as table:
            yield self._valid(self.spark.table(table), now["dates"]).groupBy("meta_id").agg(F.count("*").alias("n"))

    def duplicates(self) -> int:
        """Keys of more than one row of the layer."""
        with self.counts() as counts:
            return 0 if counts is None else counts.where("n > 1").count()
