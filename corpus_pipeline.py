"""From raw documents to packed training sequences.

Each stage works on all that the stage before it kept. ``run`` writes every stage's result to the
shared folder and reads it again, so a lost executor never costs more than one stage. An empty table
stays empty in every stage.

Quality votes and packing cannot be stated in SQL, so there is no ``ORACLE_SQL``; the tests compare
the whole run with plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm.chosen_path import one_per_class
from tallyforge.llm.line_runs import NOT_BLANK, drop_repeated_lines
from tallyforge.llm.neighbour_quality import ACCEPT, fit_voters, held_out, vote
from tallyforge.llm.packing import pack
from tallyforge.llm.queries_packing import RANKS, TOKENIZER
from tallyforge.llm.tables import table, written
from tallyforge.llm.winnowing import clean_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled texts accept; all if there is no labelled text.

    A null text is judged as an empty one, a row without an id like any other, and repeated rows alike.
    """
    labels = table(spark, sf_dir, "labels")
    voters = fit_voters(labels.where(~held_out()), docs)
    if voters is None:
        return docs
    scored = vote(docs, voters)
    return scored.where(F.col("quality_score") >= ACCEPT).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated lines; those left without a word go.

    Null texts stay. A row without an id comes before all others; repeated rows are cut alike.
    """
    cut = drop_repeated_lines(docs)
    changed = F.col("n_removed") > 0
    kept = cut.where(~changed | F.col("text").rlike(NOT_BLANK))
    return kept.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id.

    Null texts and texts without a word have no copies, unless rows are repeated: of rows with the same
    id and text one stays. A row without an id stays if no row of its group has one.
    """
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text.

    Null texts stay; a row without an id is judged like any other, and repeated rows alike.
    """
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 1024.

    A null text is packed as an empty one; rows without an id and repeated rows are packed each for itself.
    """
    return pack(docs, TOKENIZER, RANKS)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
