"""Imports every module that registers queries."""

from . import interval_queries, relational_queries, stage_queries, text_queries, vector_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
