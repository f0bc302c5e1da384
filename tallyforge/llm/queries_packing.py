"""Query over the whole ``documents`` table: packing into training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.packing import pack
from tallyforge.llm.registry import query
from tallyforge.llm.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query()
def op2_bounded_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 ids."""
    return pack(table(spark, folder, "documents"), TOKENIZER, RANKS, with_ids=False)
