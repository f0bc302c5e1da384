"""Keeping an intermediate table for the several passes a model fit makes over it."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors can reach, if the cluster names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


_made: dict[str, SparkSession] = {}


def on_one_machine(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table or model, which is removed when the process ends.

    Without a configured folder a temporary one is used, which is only sound when driver and
    executors are the same machine; anywhere else that is an error.
    """
    folder = shared_folder(spark)
    if folder is None:
        if not on_one_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallyforge-")
    path = f"{folder.rstrip('/')}/tallyforge/{name}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


@atexit.register
def _remove_made() -> None:
    """What results may still have read from is removed last, if the session is still there."""
    for path, spark in list(_made.items()):
        context = spark.sparkContext
        if context._jsc is not None and not context._jsc.sc().isStopped():
            delete_path(spark, path)


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the session has cores.

    A large table has far more splits than cores and passes through unchanged, so this never
    shuffles data at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# Room in memory of the rows that one task of a fit keeps, and of a row beside its vector's entries.
FIT_BYTES = 64 << 20
ROW_BYTES = 200
OPEN_COST = "spark.sql.files.openCostInBytes"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# Files that a task keeps open while it deals rows to parts; with more parts the rows are sorted first.
OPEN_FILES = 16


def rows_per_task(entries: int) -> int:
    """How many rows with vectors of so many entries one task of a fit should keep."""
    return max(1_000, FIT_BYTES // (ROW_BYTES + 4 * entries))


def side_by_side(rows: DataFrame, most: int) -> int:
    """How many fits on ``rows`` to run at once, at most ``most``.

    Every running fit keeps its own copy of the rows, so where one has tasks for all cores several only
    drive each other's rows out of memory.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(most, most * cores // max(1, rows.rdd.getNumPartitions())))


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session, for the length of a ``with`` block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def one_file_per_task(spark: SparkSession) -> Iterator[None]:
    """Have scans read every file by a task of its own, for the length of a ``with`` block."""
    # A file that costs as much as a whole split shares its task with no other.
    with _setting(spark, OPEN_COST, spark.conf.get("spark.sql.files.maxPartitionBytes")):
        yield


@contextmanager
def staged(
    df: DataFrame, name: str = "stage", entries: int | None = None, parts: Sequence[str] = ()
) -> Iterator[DataFrame]:
    """``df`` made cheap to read several times, for the length of a ``with`` block.

    With ``entries``, the length of its vectors, the table is for a fit, which keeps its rows in memory:
    they take many times the room they have on disk, so files are held to what one task may keep and each
    is read by its own task. Tasks then grow in number with the table, not in size. With ``parts``, columns
    of few values, rows are kept apart by them: a filter on these columns reads only the files it needs.

    On a cluster it is written once to the shared folder and deleted afterwards: the copy outlives
    lost executors, cuts the lineage and takes no executor memory. Without such a folder it is
    persisted instead on a single machine, and refused on a cluster. Column metadata (category names, vector sizes) survives both ways.
    """
    spark = df.sparkSession
    if shared_folder(spark) is None:
        if not on_one_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield kept
        finally:
            kept.unpersist()
        return
    path = new_shared_path(spark, name)
    try:
        if entries is None:
            df.write.parquet(path)
            yield spark.read.schema(df.schema).parquet(path)
        else:
            with _setting(spark, WRITERS, str(OPEN_FILES)):
                files = df.write.option("maxRecordsPerFile", rows_per_task(entries))
                files.partitionBy(*parts).parquet(path) if parts else files.parquet(path)
            with one_file_per_task(spark):
                yield spark.read.schema(df.schema).parquet(path).select(df.columns)
    finally:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a table written by :func:`staged`, on whatever file system holds it."""
    _made.pop(path, None)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


# Rows that may be brought to the driver as a result of a study.
MAX_SETTLED = 100_000


def settle(df: DataFrame, max_rows: int = MAX_SETTLED) -> DataFrame:
    """Compute a small table now, so that it no longer depends on anything staged.

    For measures, leaves of a tree, cluster summaries. At most one row more than ``max_rows`` is
    collected; a larger table is then computed anew and written to the shared folder.
    """
    spark = df.sparkSession
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return spark.createDataFrame(rows, df.schema)
    path = new_shared_path(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
