"""Registered queries: one per operator, each with SQL for the same result."""

from .registry import QUERIES, SQL
from . import scalars, stats, comparisons, merges, windows, checks, sources, layouts, assembly  # noqa: E402,F401

__all__ = ["QUERIES", "SQL"]
