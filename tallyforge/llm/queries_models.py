"""Queries over the whole ``documents`` table: language, toxicity and quality of every text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.boosted_toxicity import score_toxicity
from tallyforge.llm.byte_cnn import identify
from tallyforge.llm.neighbour_quality import score_quality
from tallyforge.llm.registry import query
from tallyforge.llm.tables import table


@query()
def op1_language_cnn(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learned outside the held-out part."""
    return identify(table(spark, folder, "documents"))


@query()
def op4_boosted_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every text, learned outside the held-out part."""
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op8_neighbour_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every text, learned outside the held-out part."""
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
