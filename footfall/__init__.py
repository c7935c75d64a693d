"""Per-customer behaviour features from e-commerce events and orders, on Spark."""

from footfall.params import RunParams
from footfall.plans.daily import Targets, run_daily
from footfall.sources.registry import Sources

__all__ = ["RunParams", "Sources", "Targets", "run_daily"]
