"""Classification and clustering studies on tabular data, built on Spark DataFrames and MLlib."""

from tallyforge.spec import FeatureSpec

__all__ = ["FeatureSpec"]
