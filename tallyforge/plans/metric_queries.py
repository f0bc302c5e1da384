"""Catalogue: measures on predictions that are known, so SQL can state every value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.operators import metrics, relational
from tallyforge.plans.registry import query
from tallyforge.plans.shared import FLOWS, SCORED, scored_flows
from tallyforge.sources.tables import flows

CELLS = f"""with {FLOWS}, {SCORED}, cells as (
  select count(*)::double as total,
    count(*) filter (prediction = 1.0 and truth = 1.0)::double as tp,
    count(*) filter (prediction = 0.0 and truth = 0.0)::double as tn,
    count(*) filter (prediction = 1.0 and truth = 0.0)::double as fp,
    count(*) filter (prediction = 0.0 and truth = 1.0)::double as fn
  from scored)"""


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return relational.contingency(scored_flows(spark, folder), truth="truth")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query(f"with {FLOWS}, {SCORED} select prediction, truth, count(*) as n from scored group by 1, 2")
def contingency(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(spark, folder)


@query(f"with {FLOWS}, {SCORED} select prediction, count(*) as n from scored group by 1")
def prediction_histogram(spark: SparkSession, folder: str) -> DataFrame:
    histogram = relational.prediction_histogram(_counts(spark, folder))
    return histogram.select("prediction", F.col("n").cast("bigint").alias("n"))


@query(
    f"""{CELLS} select total::bigint as total, (tp + tn)::bigint as correct,
  (fp + fn)::bigint as incorrect, round((tp + tn) / total, 6) as ratio_correct,
  round((fp + fn) / total, 6) as ratio_incorrect from cells"""
)
def correct_incorrect(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.agreement(_counts(spark, folder))
    ratios = ["ratio_correct", "ratio_incorrect"]
    return found.withColumns({c: F.round(c, 6) for c in ratios})


@query(
    f"""{CELLS} select round((tp + tn) / total, 6) as accuracy,
  round(1 - (tp + tn) / total, 6) as error_rate from cells"""
)
def accuracy_error_rate(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.accuracy(_counts(spark, folder)))


@query(
    f"""{CELLS} select round(tp / total, 6) as tp, round(tn / total, 6) as tn,
  round(fp / total, 6) as fp, round(fn / total, 6) as fn from cells"""
)
def confusion_over_total(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.confusion_over_total(_counts(spark, folder), 1.0, 0.0))


@query(
    f"""{CELLS} select round(tn / total, 6) as tp, round(tp / total, 6) as tn,
  round(fn / total, 6) as fp, round(fp / total, 6) as fn from cells"""
)
def confusion_attack_positive(spark: SparkSession, folder: str) -> DataFrame:
    """The same cells with the attack class as the positive one."""
    return _rounded(metrics.confusion_over_total(_counts(spark, folder), 0.0, 1.0))


@query(
    f"""{CELLS} select round(tp / (tp + fp), 6) as tp_rate, round(tn / (tn + fn), 6) as tn_rate,
  round(fp / (tn + fn), 6) as fp_rate, round(fn / (tp + fp), 6) as fn_rate from cells"""
)
def confusion_over_predicted(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.confusion_over_predicted(_counts(spark, folder), 1.0, 0.0))


@query(
    f"""{CELLS} select round(tp / (tp + fp), 6) as "precision", round(tp / (tp + fn), 6) as recall,
  round(fp / (fp + tn), 6) as fpr, round(fn / (fn + tp), 6) as fnr,
  round(2 * tp / (2 * tp + fp + fn), 6) as f1 from cells"""
)
def confusion_standard(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.confusion_standard(_counts(spark, folder), 1.0, 0.0))


# Every pair of a normal and another row counts 1 if the normal one scores higher, 1/2 on a tie.
@query(
    f"""with {FLOWS}, by_score as (
  select src_bytes, count(*) filter (class = 'normal')::double as p,
    count(*) filter (class <> 'normal')::double as n from flows group by src_bytes),
above as (
  select p, n, sum(p) over (order by src_bytes desc rows unbounded preceding) as p_so_far
  from by_score)
select round(sum(n * (p_so_far - p / 2)) / (sum(p) * sum(n)), 6) as auc from above"""
)
def auc_roc(spark: SparkSession, folder: str) -> DataFrame:
    is_normal = F.when(F.col("class") == "normal", F.lit(1.0)).otherwise(F.lit(0.0))
    scored = flows(spark, folder).select("src_bytes", is_normal.alias("label"))
    area = metrics.auc_roc(scored, "src_bytes")
    return spark.createDataFrame([(round(area, 6),)], "auc double")


@query(
    f"""with {FLOWS}, by_score as (
  select duration, count(*) filter (class = 'normal')::double as p,
    count(*) filter (class <> 'normal')::double as n from flows group by duration),
above as (
  select p, n, sum(p) over (order by duration desc rows unbounded preceding) as p_so_far
  from by_score)
select round(sum(n * (p_so_far - p / 2)) / (sum(p) * sum(n)), 6) as auc from above"""
)
def auc_roc_counted(spark: SparkSession, folder: str) -> DataFrame:
    """The curve from counted groups of equal scores: the rows themselves are scanned once."""
    is_normal = F.when(F.col("class") == "normal", F.lit(1.0)).otherwise(F.lit(0.0))
    groups = relational.value_counts(
        flows(spark, folder).select("duration", is_normal.alias("label")), "duration", "label"
    )
    area = metrics.auc_roc(groups, "duration", weight="n")
    return spark.createDataFrame([(round(area, 6),)], "auc double")
