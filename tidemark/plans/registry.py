"""Queries by name, and their SQL."""

from __future__ import annotations

from tidemark.plans import lookups, merging, policies, reports, texts  # noqa: F401
from tidemark.plans.base import QUERIES, SQL

FLAGSHIP = "gap_clusters"

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]
