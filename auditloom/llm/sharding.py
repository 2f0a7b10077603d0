"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in a total order. A Feistel network over a grid of about the square root of
the number of rows by the same permutes the numbers; a number that leaves the range walks
on along its cycle until it is inside again. The permuted number gives shard and slot by
division, and back: both directions are computed from the number alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from auditloom.llm.common import durable

ROUNDS = 6
_MASK = np.uint64(0xFFFFFFFF)
_KEY, _FIRST, _SECOND = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35


class Permutation:
    """A bijection of 0 .. rows - 1. Below 2**62 rows."""

    def __init__(self, rows: int, seed: int = 0):
        self.rows = rows
        self.left = max(1, math.isqrt(max(0, rows - 1)) + 1)
        self.right = max(1, -(-rows // self.left))
        self.keys = [(seed * ROUNDS + k + 1) * _KEY % (1 << 32) for k in range(ROUNDS)]

    @staticmethod
    def _mix(x: np.ndarray, key: int) -> np.ndarray:
        x = (x + np.uint64(key)) & _MASK
        x = ((x ^ (x >> np.uint64(15))) * np.uint64(_FIRST)) & _MASK
        x = ((x ^ (x >> np.uint64(13))) * np.uint64(_SECOND)) & _MASK
        return x ^ (x >> np.uint64(16))

    def _network(self, x: np.ndarray) -> np.ndarray:
        a, b = np.uint64(self.left), np.uint64(self.right)
        left, right = x // b, x % b
        for k, key in enumerate(self.keys):
            if k % 2 == 0:
                left = (left + self._mix(right, key) % a) % a
            else:
                right = (right + self._mix(left, key) % b) % b
        return left * b + right

    def _reverse(self, x: np.ndarray) -> np.ndarray:
        a, b = np.uint64(self.left), np.uint64(self.right)
        left, right = x // b, x % b
        for k, key in reversed(list(enumerate(self.keys))):
            if k % 2 == 0:
                left = (left + a - self._mix(right, key) % a) % a
            else:
                right = (right + b - self._mix(left, key) % b) % b
        return left * b + right

    def _walk(self, step, numbers) -> np.ndarray:
        x = step(np.asarray(numbers).astype(np.uint64))
        outside = np.flatnonzero(x >= self.rows)
        while len(outside):
            x[outside] = step(x[outside])
            outside = outside[x[outside] >= self.rows]
        return x.astype(np.int64)

    def forward(self, numbers) -> np.ndarray:
        return self._walk(self._network, numbers)

    def backward(self, numbers) -> np.ndarray:
        return self._walk(self._reverse, numbers)


def row_at(shard: int, slot: int, rows: int, shards: int, seed: int = 0) -> int | None:
    """Number of the row at a place; None if the shard is shorter."""
    place = slot * shards + shard
    return int(Permutation(rows, seed).backward([place])[0]) if place < rows else None


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``row_number`` from 0 in the order of columns, nulls first.

    A range shuffle and a checkpoint fix the order; one count per partition gives the offsets.
    Rows that tie in all columns are alike, so their order is of no account.
    """
    placed = (df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in order))
              .sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in order))
              .withColumn("_id", F.monotonically_increasing_id()))
    placed = durable(placed).withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)})
    # One row per partition of the shuffle, however many rows there are.
    counts = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    starts = placed.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    return placed.join(F.broadcast(starts), "_part").withColumn("row_number", F.col("_start") + F.col("_at")).drop("_id", "_part", "_at", "_start")


def shards(documents: DataFrame, count: int = 24, seed: int = 0) -> DataFrame:
    """Every row of ``documents`` (``doc_id``, ``text``; other columns are ignored) in one of ``count``
    shards: ``doc_id``, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``row_number``,
    ``shard`` and ``slot``. Shards differ by one row at most and slots have no gaps.

    Rows are numbered by doc_id, then checksum, then size; null ids come first. A null text has
    size 8 and checksum 0. Texts are not moved.
    """
    rows = numbered(documents.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32")), "doc_id", "text_crc32", "size")
    permutation = Permutation(rows.count(), seed)

    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(numbers.to_numpy()))

    return (rows.withColumn("_place", F.pandas_udf(place, "bigint")("row_number"))
            .withColumns({"shard": (F.col("_place") % count).cast("int"), "slot": F.floor(F.col("_place") / count).cast("bigint")})
            .drop("_place"))
