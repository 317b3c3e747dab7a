"""Registered queries: Spark callables and, where SQL can express them, their DuckDB twins."""

# Queries run in the order of registration; those that fit models take longest and come last.
from catalog import aggregates, families, scalars, scores, sources, text, windows  # isort: skip
from catalog import models  # isort: skip
from catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "aggregates", "families", "models", "scalars", "scores", "sources", "text", "windows",
]
