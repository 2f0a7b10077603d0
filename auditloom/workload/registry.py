"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from auditloom.workload.binding import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable:
    """Register a function ``f(tables) -> DataFrame`` under its own name."""
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, build, sql, tuple(covers.split()))
        return build

    return add
