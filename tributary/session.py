"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the jobs expect; applied by ``configure`` only where they are unset.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot compiles no method beyond 8000 bytes: a stage whose generated
    # method is longer would be interpreted, so its operators run one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A persisted frame lives for one job: trying codecs on each of its values
    # costs more than the room they save (a third).
    "spark.sql.inMemoryColumnarStorage.compressed": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RECOMMENDED_CONF`` without overriding what the cluster set.

    The session zone matters for results: event dates and hours are taken in
    it, and the tests and oracles assume UTC.
    """
    for key, value in RECOMMENDED_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (tests, oracles and the query catalog), with
    the recommended settings."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A local folder is created only in local mode when nothing is set (tests);
    on a cluster an unset directory is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a shared folder for this job.")
    local = tempfile.mkdtemp(prefix="tributary-checkpoint-")
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder, computed once.

    ``checkpoint(eager=True)`` runs one job to count and a second to write
    the files, which recomputes the frame unless it is persisted; persisting
    first makes the write read the cached blocks. The files survive executor
    loss; the cache is dropped once they exist.
    """
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tributary"):
    """Session for tests and the benchmark (local mode)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
