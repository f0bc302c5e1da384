"""SQL text and inputs that several catalogue queries have in common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.functions.recode import class_binarize
from tallyforge.operators.features import FeatureModel, fit_features
from tallyforge.operators.split import in_training
from tallyforge.sources.tables import FLOW_KEY, FLOWS_SQL, flows
from tallyforge.spec import connection_spec

SPEC = connection_spec(key=[FLOW_KEY])
NUMERIC = ("duration", "src_bytes", "serror_rate", "rerror_rate")

FLOWS = f"flows as ({FLOWS_SQL})"
IN_TRAINING = "('0x' || substr(md5(flow_key), 1, 8))::bigint % 100 < 70"

# Rows that a toss per key with a seed puts in the training part.
IN_TOSS = "('0x' || substr(md5('toss {seed}|' || flow_key), 1, 8))::bigint < round(0.7 * 4294967296)"

# The rule behind the label, and a deliberately different rule that plays the part of a model where
# a measure is checked on known predictions.
IS_NORMAL = "duration > 25 and land = 1"
RULE_ON_TEST = f"""with {FLOWS}
select flow_key, case when {IS_NORMAL} then 1.0 else 0.0 end::double as prediction
from flows where not ({IN_TRAINING})"""
GUESS = "duration > 20 and land = 1 and logged_in = 0"
SCORED = f"""scored as (
  select flow_key, class,
    case when {GUESS} then 1.0 else 0.0 end::double as prediction,
    case when class = 'normal' then 1.0 else 0.0 end::double as truth
  from flows)"""


def scored_flows(spark: SparkSession, folder: str) -> DataFrame:
    """All connection records with the fixed guess as prediction."""
    return flows(spark, folder).select(
        FLOW_KEY,
        "class",
        F.when(F.expr(GUESS), F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
        F.when(F.col("class") == "normal", F.lit(1.0)).otherwise(F.lit(0.0)).alias("truth"),
    )


def binary_flows(spark: SparkSession, folder: str, spread: bool = True) -> DataFrame:
    return flows(spark, folder, spread).withColumn("class", class_binarize("class"))


def encoded_flows(
    spark: SparkSession, folder: str, encoding: str = "onehot"
) -> tuple[FeatureModel, DataFrame]:
    """Normal-or-attack records as vectors, with the training flag of every row."""
    data = binary_flows(spark, folder)
    features = fit_features(data, SPEC, encoding)
    rows = features.transform(data).select(
        FLOW_KEY, in_training(FLOW_KEY).alias("train"), "features", "label"
    )
    return features, rows


def long_values(columns: Sequence[str], key: str = "flow_key, ") -> str:
    """SQL for the text of several columns as (name, value) rows."""
    return " union all ".join(
        f"select {key}'{c}' as name, {c}::varchar as value from flows" for c in columns
    )


def ranks(columns: Sequence[str]) -> str:
    """SQL CTEs that number the categories of ``columns`` by falling frequency."""
    return f"""long_values as ({long_values(columns)}),
ranks as (
  select name, value, row_number() over (partition by name order by count(*) desc, value) - 1 as idx
  from long_values where value is not null group by name, value)"""
