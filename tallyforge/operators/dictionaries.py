"""Category dictionaries: every distinct value of a column numbered by falling frequency.

Index 0.0 is the most frequent value and ties are numbered in ascending text order, the ordering of
``StringIndexer``. The values are counted by an ordinary aggregation, so a column with too many
values to hold on the driver is still numbered exactly, by a distributed sort.

How a dictionary is held, as a list or as a table, changes nothing about the index column: the
numbers, the handling of nulls and unseen values and the number of categories in its metadata are
the same. Only the list also puts the values' names there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyforge.staging import new_shared_path

# Dictionaries collected to the driver and sent to every task, all columns of a fit together: values,
# and bytes of text.
MAX_DICTIONARY = 100_000
MAX_DICTIONARY_BYTES = 64 << 20


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, as ``(name, value, n)``, in one pass; nulls are left out.

    All columns are counted by the same aggregation (one scan however many columns), with partial
    counts inside each task.
    """
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    return (
        df.select(*texts)
        .unpivot([], list(columns), "name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count("*").alias("n"))
    )


@dataclass
class Dictionaries:
    """Numbered categories of several columns.

    ``small`` holds ordered value lists; ``large`` holds ``(value, idx)`` tables for columns whose
    dictionary is too big to broadcast, and ``sizes`` the number of values of every column.
    """

    small: dict[str, list[str]] = field(default_factory=dict)
    large: dict[str, DataFrame] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)
    max_size: int = MAX_DICTIONARY

    def labels(self, column: str) -> list[str]:
        if column in self.large:
            raise ValueError(f"the dictionary of {column} is too large to collect")
        return self.small[column]

    def indexer(self, column: str, output: str, handle_invalid: str = "error") -> StringIndexerModel:
        """A fitted indexer for a small column (a literal lookup, no job)."""
        return StringIndexerModel.from_labels(
            self.labels(column), inputCol=column, outputCol=output, handleInvalid=handle_invalid
        )

    def decode(self, df: DataFrame, column: str, indices: str, output: str) -> DataFrame:
        """Put the values of ``column`` in place of their indices, however its dictionary is held."""
        if column in self.large:
            return value_by_join(df, indices, self.large[column], output, self.max_size, self.sizes.get(column))
        return IndexToString(inputCol=indices, outputCol=output, labels=self.small[column]).transform(df)

    def table(self, spark: SparkSession, column: str) -> DataFrame:
        """A column's dictionary as ``(value, idx)`` rows, however it is held."""
        if column in self.large:
            return self.large[column]
        rows = [(v, float(i)) for i, v in enumerate(self.small[column])]
        return spark.createDataFrame(rows, "value string, idx double")


def fit_dictionaries(
    df: DataFrame, columns: Sequence[str], max_size: int = MAX_DICTIONARY
) -> Dictionaries:
    """Count and number the categories of ``columns`` with one scan of ``df``."""
    counts = category_counts(df, columns).persist()
    try:
        return _numbered(counts, columns, max_size)
    finally:
        counts.unpersist()


def _numbered(counts: DataFrame, columns: Sequence[str], max_size: int) -> Dictionaries:
    measured = counts.groupBy("name").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes")
    )
    sizes = {r["name"]: (r["n"], r["bytes"]) for r in measured.collect()}  # one row per column
    result = Dictionaries(max_size=max_size, sizes={c: sizes.get(c, (0, 0))[0] for c in columns})
    # The smallest dictionaries first, as long as all collected ones together keep the bounds.
    fits, values_left, bytes_left = [], max_size, MAX_DICTIONARY_BYTES
    for column in sorted(set(columns), key=lambda c: (sizes.get(c, (0, 0)), c)):
        n, size = sizes.get(column, (0, 0))
        values_left, bytes_left = values_left - n, bytes_left - size
        if values_left < 0 or bytes_left < 0:
            break
        fits.append(column)
    values: dict[str, list[tuple[int, str]]] = {c: [] for c in fits}
    for row in counts.filter(F.col("name").isin(fits)).collect():
        values[row["name"]].append((-row["n"], row["value"]))
    for column in fits:
        result.small[column] = [value for _, value in sorted(values[column])]
    for column in columns:
        if column not in result.small:
            result.large[column] = rank_values(
                counts.filter(F.col("name") == column).select("value", "n")
            )
    return result


def rank_values(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """Number ``(value, n)`` rows by falling ``n`` without bringing them together.

    The rows are range-partitioned by rank order and written once, so that partition numbers stay
    fixed; a row's index is its place inside its range plus the size of the ranges before it.
    """
    spark = counts.sparkSession
    order = [F.col("n").desc(), F.col("value").asc()]
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_shared_path(spark, "ranges")
    (
        counts.select("value", F.col("n").cast("bigint").alias("n"))
        .repartitionByRange(width, *order)
        .withColumn("part", F.spark_partition_id())
        .write.parquet(path)
    )
    ranges = spark.read.schema("value string, n bigint, part int").parquet(path)
    # One row per range: bounded by the number of partitions.
    sizes = ranges.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return (
        ranges.withColumn("place", place)
        .join(F.broadcast(offsets), "part")
        .select("value", (F.col("start") + F.col("place") - 1).cast("double").alias("idx"))
    )


def index_by_join(
    df: DataFrame,
    column: str,
    ranks: DataFrame,
    output: str,
    handle_invalid: str = "error",
    head: int = MAX_DICTIONARY,
    size: int | None = None,
) -> DataFrame:
    """Look ``column`` up in a dictionary of any size; the input is read once.

    The ``head`` most frequent values are broadcast, which settles every heavy value; very long
    values shrink the head so that its bytes are bounded as well. The rest of the dictionary is
    joined by a shuffle in which no key is heavy: settled rows and nulls go by a hash of their whole
    row, which matches nothing.
    """
    size = ranks.count() if size is None else size
    key = F.col(f"`{column}`").cast("string")
    head = _bounded_head(ranks, head)
    hot = F.broadcast(
        ranks.filter(F.col("idx") < head).select(
            F.col("value").alias("__value"), F.col("idx").alias("__hot")
        )
    )
    columns = [f"`{c}`" for c in df.columns]
    indexed = df.join(hot, key == F.col("__value"), "left").drop("__value")
    found = F.col("__hot")
    if size > head:
        cold = ranks.filter(F.col("idx") >= head).select(
            F.col("value").alias("__value"), F.col("idx").alias("__cold")
        )
        settled = found.isNotNull() | key.isNull()
        spread = F.struct(F.lit(True).alias("settled"), F.xxhash64(*columns).cast("string").alias("value"))
        sought = F.struct(F.lit(False).alias("settled"), key.alias("value"))
        indexed = indexed.withColumn("__key", F.when(settled, spread).otherwise(sought))
        cold = cold.select(
            F.struct(F.lit(False).alias("settled"), F.col("__value").alias("value")).alias("__known"), "__cold"
        )
        indexed = indexed.join(cold, F.col("__key") == F.col("__known"), "left")
        found = F.coalesce(F.col("__hot"), F.col("__cold"))
    categories = size
    if handle_invalid == "skip":
        indexed = indexed.filter(found.isNotNull())
    elif handle_invalid == "keep":
        found, categories = F.coalesce(found, F.lit(float(size))), size + 1
    else:
        failure = F.raise_error(
            F.concat(F.lit(f"null or unseen value in {column}: "), F.coalesce(key, F.lit("null")))
        ).cast("double")
        found = F.when(found.isNull(), failure).otherwise(found)
    nominal = {"ml_attr": {"type": "nominal", "name": output, "num_vals": categories}}
    return indexed.select(*columns, found.alias(output, metadata=nominal))


def value_by_join(
    df: DataFrame,
    indices: str,
    ranks: DataFrame,
    output: str,
    head: int = MAX_DICTIONARY,
    size: int | None = None,
) -> DataFrame:
    """Look the numbers in ``indices`` up in a dictionary of any size: the reverse of :func:`index_by_join`.

    The values with the ``head`` smallest indices, so the most frequent ones, are broadcast within
    the same bounds. In the shuffle join of the rest, settled rows go by a hash of their whole row. A
    null index, or one that the dictionary does not have, is an error, as with a list of values.
    """
    size = ranks.count() if size is None else size
    key = F.col(f"`{indices}`").cast("double")
    head = _bounded_head(ranks, head)
    columns = [f"`{c}`" for c in df.columns]
    hot = F.broadcast(
        ranks.filter(F.col("idx") < head).select(F.col("idx").alias("__idx"), F.col("value").alias("__hot"))
    )
    decoded = df.join(hot, key == F.col("__idx"), "left").drop("__idx")
    found = F.col("__hot")
    if size > head:
        settled = found.isNotNull() | key.isNull()
        spread = F.struct(F.lit(True).alias("settled"), F.xxhash64(*columns).alias("place"))
        sought = F.struct(F.lit(False).alias("settled"), F.xxhash64(key).alias("place"))
        decoded = decoded.withColumn("__key", F.when(settled, spread).otherwise(sought))
        cold = ranks.filter(F.col("idx") >= head).select(
            F.struct(F.lit(False).alias("settled"), F.xxhash64("idx").alias("place")).alias("__place"),
            F.col("idx").alias("__idx"),
            F.col("value").alias("__cold"),
        )
        decoded = decoded.join(cold, (F.col("__key") == F.col("__place")) & (key == F.col("__idx")), "left")
        found = F.coalesce(F.col("__hot"), F.col("__cold"))
    number = F.coalesce(key.cast("string"), F.lit("null"))
    failure = F.raise_error(F.concat(F.lit(f"no value has the index in {indices}: "), number))
    found = F.when(found.isNull(), failure.cast("string")).otherwise(found)
    return decoded.select(*columns, found.alias(output))


def _bounded_head(ranks: DataFrame, head: int) -> int:
    """How many of the most frequent values may be broadcast: very long ones shrink the number."""
    longest = ranks.filter(F.col("idx") < head).agg(F.max(F.octet_length("value"))).first()[0]
    return max(1, min(head, MAX_DICTIONARY_BYTES // max(longest or 0, 1)))
