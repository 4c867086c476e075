"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm import centroids, divergence, exact_dedup, inner_products, licenses, mixing, neighbours, packing, quality, secrets, simhash, token_counts, toxicity

_MODULES = (quality, toxicity, secrets, neighbours, simhash, token_counts, packing, exact_dedup, licenses, mixing, divergence, centroids, inner_products)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
