"""All queries, gathered by importing the modules that define them."""

from tessera.plans import features, modelling, pixels, scoring, tables  # noqa: F401
from tessera.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
