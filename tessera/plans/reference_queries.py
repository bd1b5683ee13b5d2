"""All queries of the relational, text, graph, search and quality operators."""

from __future__ import annotations

from importlib import import_module

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in ("scalar_queries", "relational_queries", "aggregate_queries", "graph_queries", "search_queries", "quality_queries", "incremental_queries", "extract_queries", "source_queries", "document_queries", "delta_queries", "vector_queries", "law_queries", "review_queries"):
    try:
        _registry = import_module(f"tessera.plans.{_name}").R
    except ModuleNotFoundError as missing:
        if missing.name != f"tessera.plans.{_name}":
            raise
        continue
    QUERIES |= _registry.queries
    SQL |= _registry.sql
