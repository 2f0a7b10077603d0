"""Ordered line scans.

A text file is split into blocks like any other Spark input, so one very large
file is read by many tasks.  The order of lines is kept as the pair
(``block``, ``row``): the byte offset of the block in its file, and a number
that rises within the block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from auditloom import fixed
from auditloom.functions.numbers import col, strip


def junk_line(line: Column | str, rules: Mapping[str, Sequence[str]] = fixed.JUNK_LINES) -> Column:
    """True for blank lines, page headers and total lines."""
    text = col(line)
    tests = [text == ""]
    tests += [F.upper(text).contains(w) for w in rules["has"]]
    tests += [text.startswith(w) for w in rules["starts"]]
    tests += [text.rlike(p) for p in rules["regex"]]
    return reduce(Column.__or__, tests)


def read_lines(spark: SparkSession, paths: str | list[str],
               rules: Mapping[str, Sequence[str]] | None = fixed.JUNK_LINES) -> DataFrame:
    """Stripped lines with ``path``, ``block``, ``row``; junk lines dropped."""
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        strip("value").alias("line"))
    return raw if rules is None else raw.filter(~junk_line("line", rules))


def split_lines(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Lines of a text column as ``(keys, pos, line)``; ``pos`` starts at 0."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
