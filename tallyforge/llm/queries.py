"""All queries of this subpackage and their oracles."""

from tallyforge.llm import (  # noqa: F401  (importing a module registers its queries)
    queries_audit,
    queries_embeddings,
    queries_models,
    queries_overlap,
    queries_packing,
    queries_repeats,
    queries_rules,
    queries_secrets,
    queries_similarity,
)
from tallyforge.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
