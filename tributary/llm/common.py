"""Shared helpers of the corpus operators: table reads, staged tables, words."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import checkpoint_dir
from tributary.sources.lake import delete_folder

#: Word pattern of the corpus contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

_MASK52 = float(1 << 52)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that every executor sees, and keeps column
    pruning for later readers. Each call uses a folder of its own,
    ``<checkpoint dir>/llm-stages/<name>-<uuid>``; the folders are needed until
    the result of the query is written and can be deleted after that.
    """
    return _stored(df, _stage_path(df.sparkSession, name))


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stage_table`` for a table that nothing reads after the block: its
    folder is deleted there."""
    path = _stage_path(df.sparkSession, name)
    try:
        yield _stored(df, path)
    finally:
        delete_folder(df.sparkSession, path)


def _stage_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-stages/{name}-{uuid.uuid4().hex}"


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """In the block, a run's shuffle files go as it ends, not when the driver
    next happens to collect its garbage. For runs whose frames run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def packed(docs: DataFrame) -> Column:
    """All columns as one struct: inside it no name can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(docs: DataFrame, row: str) -> list[Column]:
    """The columns of ``docs`` from the struct that ``packed`` made of them."""
    return [F.col(row).getField(c).alias(c) for c in docs.columns]


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A ``mapInArrow`` function whose worker gives its memory back at the end.

    Spark keeps Python workers for later tasks; without this, freed memory
    stays with each idle worker and counts against its executor.
    """

    @wraps(run)
    def tidied(batches: Batches) -> Batches:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:
            pass  # another C library than glibc

    return tidied


#: Size of the Arrow batches between Spark and its Python workers, where the
#: session has Spark's defaults: whole texts are long rows, and a batch of the
#: default 10,000 of them takes tens of MB on both sides.
ARROW_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m"),
}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Prepare a session for the operators with Python code, which call it.

    Gives the executors' Python workers this package (once per application),
    as ``spark-submit --py-files`` would, and sets ``ARROW_BATCHES``."""
    sc = spark.sparkContext
    for key, (default, value) in ARROW_BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tributary-package-"), "tributary.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash52(*parts: Column) -> Column:
    """First 52 bits of the md5 of the parts joined by ``|``, as a long."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def unit(h: Column) -> Column:
    """A 52-bit hash as a double strictly between 0 and 1."""
    return (h.cast("double") + F.lit(0.5)) / F.lit(_MASK52)


def key_text(col: Column) -> Column:
    """Key as text; a null key counts as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 arrays."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def blocks(items: Iterable, size: int) -> Iterator[list]:
    block: list = []
    for item in items:
        block.append(item)
        if len(block) >= size:
            yield block
            block = []
    if block:
        yield block
