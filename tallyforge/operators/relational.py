"""Row-level and counting operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order (a bounded heap per task, no full sort)."""
    return df.orderBy(*order_by).limit(n)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct non-null value, found in one pass."""
    if not columns:
        return []
    row = df.agg(
        *[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in columns]
    ).first()
    return [c for c in columns if row[c]]


def matching(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two columns agree; a null on either side is neither agreement nor mismatch."""
    return df.filter(F.col(left) == F.col(right))


def mismatching(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.filter(F.col(left) != F.col(right))


def where_equal(df: DataFrame, **values: object) -> DataFrame:
    """Rows where every named column equals its constant."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def split_sizes(df: DataFrame, is_train: Column) -> DataFrame:
    """Row counts of the whole table and of both parts, in one aggregation."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(is_train).alias("n_train"),
        F.count_if(~is_train).alias("n_test"),
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per distinct value (null is a value of its own).

    Counts are combined inside each task first, so one dominant value moves one row per task.
    """
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def group_cardinality(df: DataFrame, column: str) -> DataFrame:
    """Number of groups, a null group included."""
    return df.select(column).distinct().agg(F.count("*").alias("n_groups"))


def count_distinct(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-null values, exact; :func:`distinct_sketches` estimates it."""
    return df.agg(F.count_distinct(column).alias("n_distinct"))


# Registers of a sketch, as a power of two: the standard error of an estimate is 1.04 / 2^(12 / 2), 1.6 %.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, column: str, *by: str, bits: int = SKETCH_BITS) -> DataFrame:
    """One mergeable sketch of the distinct non-null values of ``column`` per group of ``by``.

    A sketch is a few kilobytes however many values it has seen, so the sketches of a day or a file can
    be kept as a table and added up later without another look at the rows. They are built inside
    each task first. Groups without a value have an empty sketch.
    """
    text = F.col(column).cast("string")
    return df.groupBy(*by).agg(F.hll_sketch_agg(text, F.lit(bits)).alias("sketch"))


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of the same column added up per group of ``by``, or all of them."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_distinct(sketches: DataFrame) -> DataFrame:
    """The number of distinct values each sketch stands for, as an estimate."""
    estimate = F.hll_sketch_estimate("sketch").cast("bigint")
    return sketches.withColumn("n_distinct", estimate).drop("sketch")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def contingency(df: DataFrame, prediction: str = "prediction", truth: str = "label") -> DataFrame:
    """Rows per (prediction, truth): the single pass every agreement measure is derived from."""
    return df.groupBy(
        F.col(prediction).alias("prediction"), F.col(truth).alias("truth")
    ).agg(F.count("*").alias("n"))


def prediction_histogram(counts: DataFrame) -> DataFrame:
    """Rows per predicted value, from a contingency table."""
    return counts.groupBy("prediction").agg(F.sum("n").alias("n"))
