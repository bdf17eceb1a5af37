"""Order-level unit economics on Spark DataFrames."""

from marginfold.params import EconomicsParams
from marginfold.plans.mart import Mart

__all__ = ["EconomicsParams", "Mart"]
