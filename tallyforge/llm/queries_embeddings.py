"""Query over the whole ``embeddings`` table: whitening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.registry import query
from tallyforge.llm.tables import table
from tallyforge.llm.whitening import whiten


@query()
def op13_exact_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on the sixteen leading components, scaled to unit variance."""
    return whiten(table(spark, folder, "embeddings"))
