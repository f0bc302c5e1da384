"""Written intermediate tables, row keys and small column helpers shared by the operators."""

from __future__ import annotations

import gc
import time
import weakref
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    NumericType,
    StringType,
    StructType,
    TimestampType,
)

from tallyforge.staging import delete_path, new_shared_path

#: Where the tables handed out by :func:`written` lie.
_paths: dict[int, tuple[str, weakref.ref]] = {}


#: Rows per Arrow batch: long texts must not add up in a Python worker.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def modest_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python in batches of at most ``BATCH_ROWS`` rows, for the session."""
    if not 0 < int(spark.conf.get(BATCH_SETTING, "10000")) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that later steps survive lost executors.

    A lazy result may still read it after the operator has returned, so the table stays until
    :func:`discard` or until the Python process ends (see ``staging``).
    """
    spark = df.sparkSession
    modest_batches(spark)
    path = new_shared_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    result = spark.read.schema(df.schema).parquet(path)
    _paths[id(result)] = path, weakref.ref(result, lambda _, key=id(result): _paths.pop(key, None))
    return result


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing reads any more."""
    if id(df) in _paths:
        delete_path(df.sparkSession, _paths.pop(id(df))[0])


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps that are over.

    It does so once the driver has dropped what refers to them, which can otherwise take long. The
    driver's Python lets go of its references first, so the JVM is asked twice.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once per row, also inside other lambdas."""
    return F.element_at(F.transform(F.array(value), then), 1)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""

    def of(value: Column, kind: DataType) -> Column:
        if isinstance(kind, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 16
        if isinstance(kind, ArrayType) and fixed(kind.elementType):
            return F.greatest(F.size(value), F.lit(0)) * fixed(kind.elementType) + 24
        if fixed(kind):
            return F.lit(fixed(kind))
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 32

    return sum((of(F.col(f"`{f.name}`"), f.dataType).cast("long") for f in df.schema.fields), F.lit(16).cast("long"))


def fixed(kind: DataType) -> int:
    """Bytes of a type whose values all take the same room; 0 for others."""
    if isinstance(kind, (NumericType, BooleanType, DateType, TimestampType)):
        return 16 if isinstance(kind, DecimalType) else 8
    if isinstance(kind, StructType) and all(fixed(f.dataType) for f in kind.fields):
        return 16 + sum(fixed(f.dataType) for f in kind.fields)
    return 0


#: Bytes of a table that is sent to every task.
MAX_BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcasting if it is a written table of at most so many rows and bytes.

    Beyond that Spark joins by a shuffle; the result is the same.
    """
    head = df.select(row_bytes(df).alias("bytes")).limit(max_rows + 1)
    found = head.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes else df


def split_of(key: Column, parts: int) -> Column:
    """Which of ``parts`` parts a row is in, by the checksum of its key's text."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts))


def unused(name: str, df: DataFrame) -> str:
    """``name``, changed if ``df`` has a column called that."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


#: Keys with at least so many rows are looked up by broadcast, and at most so many keys.
HEAVY_ROWS = 10_000
MAX_HEAVY_KEYS = 100_000


def join_weighted(rows: DataFrame, table: DataFrame, *keys: str, total: int | None = None) -> DataFrame:
    """``rows`` joined with a written ``table`` by ``keys``, whose column ``n`` says how many rows a key has.

    Keys with many rows are broadcast: there are at most ``MAX_HEAVY_KEYS``, since each stands for its
    share of all rows. The others meet in a shuffle, in which none of them is frequent. The column ``n``
    is not part of the result. ``total`` is the sum of ``n``, if it is known already.
    """
    total = table.agg(F.sum("n")).first()[0] or 0 if total is None else total
    heavy = F.col("n") >= max(HEAVY_ROWS, total // MAX_HEAVY_KEYS)
    hot, cold = table.where(heavy).drop("n"), table.where(~heavy).drop("n")
    if total < HEAVY_ROWS or hot.isEmpty():
        return rows.join(cold, [*keys])
    settled = rows.join(F.broadcast(hot), [*keys])
    rest = rows.join(F.broadcast(hot.select(*keys).distinct()), [*keys], "left_anti").join(cold, [*keys])
    return settled.unionByName(rest)
