"""Reusable filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from auditloom.functions.keys import fiscal_year_key
from auditloom.functions.numbers import col, strip


def latest_partition(df: DataFrame, year: str = "year", source: DataFrame | None = None) -> DataFrame:
    """Rows of the greatest year.

    The maximum is a scalar subquery: on a table partitioned by year it prunes
    partitions before the files are listed, and it needs no join.
    """
    newest = (source or df).agg(F.max(year)).scalar()
    return df.filter(F.col(year) == newest)


def same_fiscal_year(c: Column | str, wanted: str) -> Column:
    """``FY2024`` and ``2023-24`` are the same year."""
    return fiscal_year_key(c) == fiscal_year_key(F.lit(wanted))


def target_filter(df: DataFrame, key: str, targets: Mapping[str, str]) -> DataFrame:
    """Rows whose key is a target code; if the table has none, rows naming a target."""
    text = strip(F.col(key).cast("string"))
    by_code = text.isin(list(targets))
    by_name = reduce(Column.__or__, [F.lower(text).contains(n.lower()) for n in targets.values()])
    any_code = df.filter(by_code).limit(1).agg(F.count(F.lit(1))).scalar() > 0
    return df.filter(by_code | (by_name & ~any_code))


def within_caps(total: Column | str, tax: Column | str, caps: Mapping[str, float]) -> Column:
    return (col(total) < caps["total"]) & (col(tax) < caps["tax"])


_OPERATORS = {
    "eq": lambda c, v: c == F.lit(v),
    "gt": lambda c, v: c > F.lit(v),
    "lt": lambda c, v: c < F.lit(v),
    "contains": lambda c, v: c.contains(v),
    "in": lambda c, v: c.isin(list(v)),
}


def structured_filters(df: DataFrame, filters: Sequence[tuple[str, str, object]]) -> DataFrame:
    """``(field, operator, value)`` triples, all of which must hold."""
    for field, operator, value in filters:
        if operator not in _OPERATORS:
            raise ValueError(f"unknown filter operator {operator!r}")
        df = df.filter(_OPERATORS[operator](F.col(field), value))
    return df
