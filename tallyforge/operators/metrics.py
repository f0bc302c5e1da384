"""Agreement, confusion and ranking measures.

All agreement measures take a contingency table ``(prediction, truth, n)``, so one scoring pass
feeds all of them. Ratios with a zero denominator are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from tallyforge.functions.recode import ratio

Label = float | int | str


def _count(condition: Column) -> Column:
    """Rows of a contingency table that satisfy ``condition`` (null counts as not satisfied)."""
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")


def _is(column: str, value: Label) -> Column:
    return F.col(column) == F.lit(value)


def _cells(positive: Label, negative: Label) -> dict[str, Column]:
    said_yes, said_no = _is("prediction", positive), _is("prediction", negative)
    yes, no = _is("truth", positive), _is("truth", negative)
    return {
        "tp": _count(said_yes & yes),
        "tn": _count(said_no & no),
        "fp": _count(said_yes & no),
        "fn": _count(said_no & yes),
    }


def agreement(counts: DataFrame) -> DataFrame:
    """Total rows, correct and incorrect ones, and both as a share of the total."""
    same = F.col("prediction") == F.col("truth")
    sums = counts.agg(
        _count(F.lit(True)).alias("total"),
        _count(same).alias("correct"),
        _count(~same).alias("incorrect"),
    )
    return sums.select(
        "total",
        "correct",
        "incorrect",
        ratio("correct", "total").alias("ratio_correct"),
        ratio("incorrect", "total").alias("ratio_incorrect"),
    )


def accuracy(counts: DataFrame) -> DataFrame:
    """Share of rows whose prediction equals the truth, and its complement."""
    share = agreement(counts).select(F.col("ratio_correct").alias("accuracy"))
    return share.withColumn("error_rate", 1 - F.col("accuracy"))


def confusion_over_total(counts: DataFrame, positive: Label, negative: Label) -> DataFrame:
    """The four confusion cells, each divided by all rows.

    Which class is positive is the caller's decision: the rarer class (index 1.0) in one
    convention, the class of normal connections in the other.
    """
    cells = _cells(positive, negative)
    sums = counts.agg(
        _count(F.lit(True)).alias("total"), *[c.alias(name) for name, c in cells.items()]
    )
    return sums.select(*[ratio(name, "total").alias(name) for name in cells])


def confusion_over_predicted(counts: DataFrame, positive: Label, negative: Label) -> DataFrame:
    """Confusion cells over predicted totals, with the false cells' denominators crossed.

    ``tp`` and ``fn`` are divided by the rows predicted positive, ``tn`` and ``fp`` by the rows
    predicted negative; ``fp`` and ``fn`` may therefore exceed 1.
    """
    sums = counts.agg(
        _count(_is("prediction", positive)).alias("said_yes"),
        _count(_is("prediction", negative)).alias("said_no"),
        *[c.alias(name) for name, c in _cells(positive, negative).items()],
    )
    return sums.select(
        ratio("tp", "said_yes").alias("tp_rate"),
        ratio("tn", "said_no").alias("tn_rate"),
        ratio("fp", "said_no").alias("fp_rate"),
        ratio("fn", "said_yes").alias("fn_rate"),
    )


def confusion_standard(counts: DataFrame, positive: Label, negative: Label) -> DataFrame:
    """Precision, recall, false positive and negative rates and F1 with their usual denominators."""
    cells = _cells(positive, negative)
    sums = counts.agg(*[c.alias(name) for name, c in cells.items()])
    tp, tn, fp, fn = (F.col(name) for name in cells)
    return sums.select(
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(fp, fp + tn).alias("fpr"),
        ratio(fn, fn + tp).alias("fnr"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def auc_roc(
    scored: DataFrame,
    score: str = "rawPrediction",
    label: str = "label",
    *,
    bins: int = 0,
    weight: str | None = None,
) -> float:
    """Area under the ROC curve over every distinct score; ``bins`` above 0 down-samples the curve.

    Rows of equal score and label are counted first, so what is sorted are distinct scores. A
    ``weight`` column says that the input is counted already.
    """
    if weight is None:
        weight = "n"
        if not isinstance(scored.schema[score].dataType, NumericType):
            scored = scored.withColumn(score, vector_to_array(score)[1])
        scored = scored.groupBy(score, label).agg(F.count("*").alias(weight))
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=bins
    )
    return evaluator.setWeightCol(weight).evaluate(scored)


def cluster_majority(counts: DataFrame) -> DataFrame:
    """The most frequent truth of every cluster (ties: the smallest), as ``(prediction, truth)``."""
    rank = F.struct(F.col("n"), -F.col("truth").cast("double"))
    return counts.groupBy("prediction").agg(F.max_by("truth", rank).alias("truth"))


def majority_counts(counts: DataFrame) -> DataFrame:
    """A contingency table with every cluster id replaced by its majority label.

    Works on the aggregated table alone: clusters are grouped once more, rows are not touched.
    """
    majority = cluster_majority(counts).select(
        F.col("prediction").alias("cluster"), F.col("truth").alias("majority")
    )
    return (
        counts.join(majority, F.col("prediction").eqNullSafe(F.col("cluster")))
        .groupBy(F.col("majority").alias("prediction"), "truth")
        .agg(F.sum("n").alias("n"))
    )


def numbered_by_size(counts: DataFrame) -> DataFrame:
    """A contingency table with clusters numbered by falling size (ties: the smaller id first).

    Cluster ids follow the random start; these numbers do not, and classes are numbered by falling
    frequency as well, so well separated clusters agree with their classes' indices.
    """
    sizes = counts.groupBy("prediction").agg(F.sum("n").alias("size"))
    place = F.row_number().over(Window.orderBy(F.desc("size"), "prediction"))  # one row per cluster
    numbers = sizes.select(F.col("prediction").alias("cluster"), (place - 1).cast("double").alias("number"))
    return counts.join(numbers, F.col("prediction").eqNullSafe(F.col("cluster"))).select(
        F.col("number").alias("prediction"), "truth", "n"
    )


def metric_table(wide: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One-row measures as ``(metric, value)`` rows."""
    names = list(columns or wide.columns)
    values = wide.select(*[F.col(c).cast("double").alias(c) for c in names])
    return values.unpivot([], names, "metric", "value")
