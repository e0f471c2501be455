"""Supervised segment mining as Spark jobs: find, refine, combine, rank and tag."""

from .conditions import Condition, Equals, Flag, InSet, Range
from .config import Feature, Roles, SearchParams, VariableRules
from .plans.mining import MiningResult, mine

__all__ = [
    "Condition", "Equals", "Feature", "Flag", "InSet", "MiningResult", "Range", "Roles",
    "SearchParams", "VariableRules", "mine",
]
