"""Run Spark SQL over registered views and preview the result."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

DEFAULT_LIMIT = 10_000
MAX_LIMIT = 100_000


@dataclass
class Result:
    """A query result that stays distributed; only the capped preview reaches the driver."""

    frame: DataFrame
    limit: int = DEFAULT_LIMIT
    elapsed_ms: float | None = None

    @property
    def columns(self) -> list[str]:
        return self.frame.columns

    @cached_property
    def _fetched(self) -> list[Row]:
        started = time.perf_counter()
        rows = self.frame.limit(self.limit + 1).collect()
        self.elapsed_ms = (time.perf_counter() - started) * 1000
        return rows

    @property
    def rows(self) -> list[Row]:
        return self._fetched[: self.limit]

    @property
    def truncated(self) -> bool:
        return len(self._fetched) > self.limit

    @cached_property
    def total_rows(self) -> int:
        """Rows before the limit; counted only if the preview was cut."""
        return self.frame.count() if self.truncated else len(self._fetched)

    def preview(self) -> DataFrame:
        """The capped rows with ``total_rows`` and ``truncated``, without the driver: the size is one row."""
        size = self.frame.agg(F.count(F.lit(1))).scalar()
        return (self.frame.limit(self.limit).withColumn("total_rows", size)
                .withColumn("truncated", F.col("total_rows") > self.limit))


def run(spark: SparkSession, sql: str, limit: int = DEFAULT_LIMIT, **params) -> Result:
    """``params`` are named SQL parameters (``:name``)."""
    if not 0 < limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return Result(spark.sql(sql, args=params or None), limit)
