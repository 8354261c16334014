"""Analytics for market price bars on Spark: collection, cleaning, features."""

from barloom.operators.indicators import add_indicators, standard_indicators
from barloom.plans.features import feature_table
from barloom.plans.job import run_job

__all__ = ["add_indicators", "feature_table", "run_job", "standard_indicators"]
