"""Registered queries over the test tables, each with its SQL where SQL can say it."""

from tidemark.suite import cleaning, evaluating, learning, quality, relations, stores  # noqa: F401
from tidemark.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
