"""Queries over the driver's tables and their SQL counterparts."""

from lexspark.plans import corpus, decisions, files, lexicon, meanings, reviews, vocabulary  # noqa: F401  registers its queries
from lexspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
