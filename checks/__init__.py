"""Registered queries, each next to the oracle SQL that checks it."""

from . import market, ordered, quality, sources, store, streams  # noqa: F401
from .base import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
