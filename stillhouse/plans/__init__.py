"""Importing this package registers all queries."""

from stillhouse.plans import answers, costs, datasets, questions, scores, serving, tasks  # noqa: F401
from stillhouse.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
