"""All registered queries and their oracles."""

from tallyforge.plans import (  # noqa: F401  (importing a module registers its queries)
    feature_queries,
    known_queries,
    metric_queries,
    model_queries,
    relational_queries,
    saved_queries,
)
from tallyforge.plans.model_queries import flagship
from tallyforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
