"""Tax-book text to property records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from auditloom import fixed
from auditloom.functions.keys import match
from auditloom.operators import extract as X
from auditloom.sources.text import read_lines


def tax_books(spark: SparkSession, paths: str | list[str], strict: bool = False,
              year: Column | None = None) -> DataFrame:
    """Property records of text books; the year is the first 20xx in the file name, or ``year`` of ``path``.

    Books are read in blocks by many tasks, and a block's lines are put together where they are read. A record that crosses a block, or is longer than a piece,
    keeps its running number, and its fields are merged; no record is gathered.
    """
    lines = read_lines(spark, paths, fixed.JUNK_LINES_STRICT if strict else fixed.JUNK_LINES)
    pieces = X.record_pieces(lines, ["path"], F.col("block"), ["block", "row"], placed=True)
    parse = X.property_records_strict if strict else X.property_records
    if year is None:
        year = match(F.element_at(F.split("path", "/"), -1), r"(20\d{2})")
    return parse(pieces, ["path"]).select(year.cast("int").alias("year"), "*")
