"""Named views over Parquet files."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def view_name(path: str) -> str:
    """File stem with ``-`` as ``_``."""
    stem = os.path.basename(path.rstrip("/"))
    return stem.removesuffix(".parquet").replace("-", "_")


def register(spark: SparkSession, path: str, name: str | None = None, on_exists: str = "error") -> str:
    """Register a Parquet path as a temp view; nothing is read beyond the footer.

    ``on_exists``: "error", "keep" (leave the existing view alone) or "replace".
    """
    if on_exists not in ("error", "keep", "replace"):
        raise ValueError(f"on_exists must be error, keep or replace, not {on_exists!r}")
    name = name or view_name(path)
    if spark.catalog.tableExists(name) and on_exists != "replace":
        if on_exists == "error":
            raise ValueError(f"view {name!r} exists")
        return name
    spark.read.parquet(path).createOrReplaceTempView(name)
    return name


def register_all(spark: SparkSession, paths: list[str], on_exists: str = "keep") -> list[str]:
    return [register(spark, p, on_exists=on_exists) for p in paths]


class Datasets:
    """Detached datasets: a name is bound to a path and becomes a view on demand."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, str]):
        self._spark = spark
        self._paths = dict(paths)
        self._loaded: set[str] = set()

    def available(self) -> list[str]:
        return sorted(self._paths)

    def is_loaded(self, name: str) -> bool:
        return name in self._loaded

    def load(self, name: str) -> DataFrame:
        if name not in self._paths:
            raise KeyError(f"unknown dataset {name!r}")
        if name not in self._loaded:
            register(self._spark, self._paths[name], name)
            self._loaded.add(name)
        return self._spark.table(name)

    def unload(self, name: str) -> None:
        if name in self._loaded:
            self._spark.catalog.dropTempView(name)
            self._loaded.discard(name)
