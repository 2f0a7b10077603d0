"""Delimited files, file families and sheet-cell tables."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from auditloom import fixed
from auditloom.functions.numbers import coded_number
from auditloom.session import durable
from auditloom.sources.ranges import blocks, dealt
from auditloom.sources.sinks import write_parquet

CELL_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("row_idx", T.IntegerType()),
    T.StructField("col_idx", T.IntegerType()),
    T.StructField("value", T.StringType()),
])

#: Most headers that are broadcast; one is a path and a position per field.
HEADERS = 20_000


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = []
        for uri in batch["path"].to_pylist():
            line = b""
            for block in blocks(uri, 0):
                line = (line + block).lstrip(b"\r\n")
                if b"\n" in line:
                    break
            heads.append(line.splitlines()[0].decode("utf-8", "replace") if line else None)
        yield pa.RecordBatch.from_arrays([batch["path"], pa.array(heads, pa.string())], names=["_path", "head"])


def headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``_path`` and ``head``, the first line that is not empty, of each file; the rest of it is not read."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    return dealt(listed).mapInArrow(_first_lines, "_path string, head string")


def read_coded_tsv(spark: SparkSession, path: str | list[str], fields: Mapping[str, str] = fixed.SURVEY_FIELDS,
                   key: str = fixed.SURVEY_KEY, codes: tuple[str, ...] = fixed.SURVEY_MISSING,
                   min_cells: int = fixed.SURVEY_MIN_CELLS, sep: str = "\t") -> DataFrame:
    """Columns looked up by each file's own header, missing-data codes as null.

    Header names absent from a file give null columns; the key is the first column where its
    name is absent. Rows with fewer than ``min_cells`` cells are dropped; longer rows that lack
    trailing cells stay. A header is the first line of its file that is not blank. Cells are not quoted.

    Tasks read the headers alone first, a row per file. They are broadcast to the scan if there are at
    most ``HEADERS``, so lines are not shuffled; beyond that Spark joins by path as it sees fit.
    """
    files = durable(headers(spark, path))
    heads = files.select("_path", *[F.array_position(F.split("head", re.escape(sep)), name).alias(f"_at_{i}") for i, name in enumerate([key, *fields])])
    # The line as one cell: no line holds the separator or the quote. The reader leaves each file's header out.
    whole = {"header": True, "enforceSchema": True, "sep": "\x01", "quote": "\x02", "escape": "\x02", "maxCharsPerColumn": -1}
    lines = (spark.read.schema("value string").options(**whole).csv(path).filter(F.length("value") > 0)
             .select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("source_file"),
                     F.split("value", re.escape(sep)).alias("_cells")))
    rows = lines.join(F.broadcast(heads) if files.count() <= HEADERS else heads, "_path").filter(F.size("_cells") >= min_cells)

    def cell(i: int) -> Column:
        at = F.col(f"_at_{i}").cast("int")
        return F.when(at > 0, F.get("_cells", at - 1))

    named = rows.select(F.when(F.col("_at_0") > 0, cell(0)).otherwise(F.get("_cells", F.lit(0))).alias(key), "source_file",
                        *[F.nullif(cell(i + 1), F.lit("")).alias(f"_v{i}") for i in range(len(fields))])
    return named.select(key, "source_file", *[coded_number(f"_v{i}", codes).alias(alias) for i, alias in enumerate(fields.values())])


def file_bucket(name: Column | str = "_metadata.file_name",
                buckets: Sequence[str] = fixed.FILE_BUCKETS) -> Column:
    """First bucket whose name occurs in the lower-cased file name; else null."""
    text = F.lower(F.col(name) if isinstance(name, str) else name)
    chain = F.when(text.contains(buckets[0]), F.lit(buckets[0]))
    for bucket in buckets[1:]:
        chain = chain.when(text.contains(bucket), F.lit(bucket))
    return chain


def read_family(spark: SparkSession, glob: str, fmt: str = "json", name: Column | str = "_metadata.file_name", **options) -> DataFrame:
    """All files of a glob in one read, each row tagged with its file and bucket; columns that a file lacks are null.
    ``name`` decides on the bucket."""
    df = spark.read.format(fmt).options(**options).load(glob)
    return df.select("*", F.col("_metadata.file_name").alias("source_file"), file_bucket(name).alias("bucket"))


def write_family(rows: DataFrame, path: str, buckets: Sequence[str] = fixed.FILE_BUCKETS) -> dict[str, DataFrame]:
    """Rows of :func:`read_family` written once, a folder per bucket, and the buckets read back: each scans its own
    folder and has only the columns that some row of it fills. Rows without a bucket are left out.
    """
    named = rows.filter(F.col("bucket").isNotNull())
    write_parquet(named, path, ["bucket"])
    spark = rows.sparkSession
    everything = spark.read.schema(named.schema).parquet(path)
    columns = [c for c in named.columns if c not in ("bucket", "source_file")]
    # One row per bucket; Parquet statistics are not needed, a count of a column reads that column only.
    filled = {r["bucket"]: r for r in everything.groupBy("bucket").agg(*[F.count(c).alias(c) for c in columns]).collect()}
    return {b: everything.filter(F.col("bucket") == b).select(*[c for c in columns if filled[b][c]], "source_file")
            for b in buckets if b in filled}


def read_cells(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Decoded sheet cells in long form; the input of the grid operators."""
    return spark.read.schema(CELL_SCHEMA).format(fmt).load(path)
