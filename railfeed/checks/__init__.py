"""Payload text derived from plain tables, the queries over it, and SQL that expects their rows."""

from . import consumers, feeds, sources, streams  # noqa: F401
from .registry import EXPECTED, QUERIES

__all__ = ["EXPECTED", "QUERIES"]
