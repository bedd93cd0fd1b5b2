"""Lake paths and guarded layer reads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tributary.schemas import BRONZE_SCHEMA


class MissingDataError(RuntimeError):
    """Raised when a layer folder holds no data file."""


def _checked(name: str, value: str | None) -> str:
    if value is None or not value.strip() or value.strip().startswith("<"):
        raise ValueError(f"Set a real value for {name} (got {value!r}).")
    return value.strip()


def lake_path(base_uri: str, layer_path: str, child: str | None = None) -> str:
    """Join a base URI (``file:/…``, ``abfss://…``, ``s3a://…``), a layer path
    and an optional table name; slashes at the joins are stripped (S10)."""
    base = _checked("base_uri", base_uri).rstrip("/")
    path = _checked("layer_path", layer_path).strip("/")
    if child:
        path = f"{path}/{child.strip('/')}"
    return f"{base}/{path}"


def partition_columns(spec: str | Sequence[str] | None) -> list[str]:
    """Comma list (or sequence) to trimmed, non-empty names; empty = unpartitioned."""
    if spec is None:
        return []
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    return [item.strip() for item in items if item and item.strip()]


_NO_DATA_CONDITIONS = ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND")


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a URI."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _is_missing(spark: SparkSession, error: Py4JJavaError) -> bool:
    return is_instance_of(spark.sparkContext._gateway, error.java_exception, "java.io.FileNotFoundException")


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when the folder (recursively) holds a data file.

    Hidden files and folders (``.`` or ``_`` in front: ``_SUCCESS``,
    ``_spark_metadata``) do not count. The file system's own iterator is
    walked and left at the first data file, so a large folder is not listed.
    Only a missing path means "no"; any other storage error is raised.
    """
    fs, root = _file_system(spark, path)
    try:
        skip = len(fs.makeQualified(root).toString().rstrip("/")) + 1
        files = fs.listFiles(root, True)
        while files.hasNext():
            parts = files.next().getPath().toString()[skip:].split("/")
            if not any(part.startswith((".", "_")) for part in parts):
                return True
    except Py4JJavaError as error:
        if not _is_missing(spark, error):
            raise
    return False


def _children(spark: SparkSession, path: str, folders: bool) -> list[str]:
    fs, root = _file_system(spark, path)
    try:
        found = fs.listStatus(root)
    except Py4JJavaError as error:
        if not _is_missing(spark, error):
            raise
        return []
    names = [status.getPath().getName() for status in found if status.isDirectory() == folders]
    return sorted(n for n in names if not n.startswith((".", "_")))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders right below ``path`` (none if it is missing)."""
    return _children(spark, path, folders=True)


def file_names(spark: SparkSession, path: str) -> frozenset[str]:
    """Names of the visible files right below ``path``."""
    return frozenset(_children(spark, path, folders=False))


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(number of files, bytes) below a folder, hidden ones included."""
    fs, root = _file_system(spark, path)
    summary = fs.getContentSummary(root)
    return summary.getFileCount(), summary.getLength()


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """Has a streaming file sink written here? Readers then see the files of
    its log only, committed batches, whatever else lies in the folder."""
    fs, root = _file_system(spark, f"{path.rstrip('/')}/_spark_metadata")
    return fs.exists(root)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, root = _file_system(spark, path)
    fs.delete(root, True)


def read_layer(
    spark: SparkSession,
    path: str,
    source_format: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """Generic layer scan (S7); a Parquet folder without data raises a clear error.

    For Parquet the guard is the read itself: Spark reports a missing folder or
    one without data files (nothing to take a schema from) while planning,
    before any job runs.
    """
    reader = spark.read.format(source_format)
    if schema is not None:
        reader = reader.schema(schema)
        if source_format == "parquet" and not has_data_files(spark, path):
            raise MissingDataError(
                f"No Parquet data files found at {path}. "
                "Run the upstream step before reading this layer."
            )
    try:
        return reader.load(path)
    except AnalysisException as exc:
        if any(cond in str(exc) for cond in _NO_DATA_CONDITIONS):
            raise MissingDataError(
                f"No Parquet data files found at {path}. "
                "Run the upstream step before reading this layer."
            ) from exc
        raise


#: Folders below Bronze. A streaming file sink keeps its own list of committed
#: files, and readers of its folder see no others, so batch runs write beside it.
BRONZE_BATCH, BRONZE_STREAM = "batch", "stream"


def read_bronze(spark: SparkSession, path: str, source_format: str = "parquet") -> DataFrame:
    """Bronze scan with its explicit schema (S6): what batch runs and what
    streams have landed, and files that lie below ``path`` beside those two
    folders (loose ones, or folders of an older lake).

    The schema keeps partition values typed as written (a numeric topic name
    stays a string), and partition filters reach each part's scan. Where a
    stream has written to ``path`` itself, its log of committed batches says
    which of the files beside the two folders count.
    """
    root = path.rstrip("/")
    folders = child_folders(spark, root)
    parts = [
        read_layer(spark, f"{root}/{child}", source_format, schema=BRONZE_SCHEMA)
        for child in (BRONZE_BATCH, BRONZE_STREAM)
        if child in folders and has_data_files(spark, f"{root}/{child}")
    ]
    if not parts:
        return read_layer(spark, root, source_format, schema=BRONZE_SCHEMA)
    reader = spark.read.format(source_format).schema(BRONZE_SCHEMA)
    if has_sink_log(spark, root):
        parts.append(reader.load(root))
    else:
        own = [name for name in folders if name not in (BRONZE_BATCH, BRONZE_STREAM)]
        if own:
            parts.append(reader.option("basePath", root).load([f"{root}/{name}" for name in own]))
        loose = sorted(file_names(spark, root))
        if loose:
            parts.append(spark.read.format(source_format).schema(BRONZE_SCHEMA).load([f"{root}/{name}" for name in loose]))
    return reduce(DataFrame.unionByName, parts)


def read_gold_table(
    spark: SparkSession, gold_path: str, table: str, source_format: str = "parquet"
) -> DataFrame:
    """One Gold table folder under the Gold base path."""
    return read_layer(spark, f"{gold_path.rstrip('/')}/{table}", source_format)
