"""Imports every module that registers queries."""

from __future__ import annotations

from foliospark.plans import changed, crawls, pages, streams, texts, trees, trends  # noqa: F401
from foliospark.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
