"""Registered queries: each operator bound to the test tables, with equivalent SQL."""

from __future__ import annotations

import importlib

from auditloom.workload.registry import QUERIES, Query

_MODULES = ("surface", "normalise", "rollup", "ranking", "trend", "check", "join", "text", "frame", "source")
def load() -> dict[str, Query]:
    """Import every query module and return the registry."""
    for name in _MODULES:
        importlib.import_module(f"auditloom.workload.{name}")
    return QUERIES

__all__ = ["QUERIES", "Query", "load"]
