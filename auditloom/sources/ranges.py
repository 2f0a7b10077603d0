"""Byte ranges of files, read inside tasks: a file of any size is the work of many tasks.

The listing comes from Spark (path and length, no contents); a task opens its file by URI and
reads a range in blocks, so its memory does not grow with the file.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of a range, and of a read inside it.
RANGE = 64 << 20
BLOCK = 4 << 20
#: Bytes of the first read behind a range.
STEP = 64 << 10


def listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """``path`` and ``bytes`` of each file under ``path``, itself a file or a folder; contents are not read.
    Spark lists no files without bytes."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path).select("path", F.col("length").cast("bigint").alias("bytes"))


def split(files: DataFrame, size: int | None = None) -> DataFrame:
    """``files`` (``path``, ``bytes``) cut into ranges ``[at, at + size)``, numbered by ``part``."""
    size = size or RANGE
    last = F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("bytes") - 1) / size))
    ranges = files.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return ranges.withColumn("at", F.col("part") * size).withColumn("size", F.least(F.lit(size).cast("bigint"), F.col("bytes") - F.col("at")))


#: Tasks of a job over ranges, at most.
TASKS = 4_000


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """The few rows, which name work, in as many tasks as that work asks for. The number is fixed, for by the bytes of
    the rows themselves they would all be put into one task.

    Rows with a ``size`` are ranges of so many bytes: a task takes ``RANGE`` bytes of them, or less where there are
    fewer than two tasks a core, so the driver does not keep a task for each small range. Others are a task each.
    """
    if "size" not in rows.columns:
        return rows.repartition(max(1, min(TASKS, rows.count())), *by)
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    wide = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-total // RANGE))
    return rows.repartition(max(1, min(TASKS, count, wide)), *by)


def open_file(uri: str):
    """A seekable binary file of any file system that Arrow knows."""
    uri = uri if "://" in uri else "file://" + uri.removeprefix("file:")
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def blocks(uri: str, at: int, size: int | None = None) -> Iterator[bytes]:
    """The bytes from ``at`` on, ``size`` of them or up to the end of the file, in blocks."""
    with open_file(uri) as file:
        left = file.size() - at if size is None else size
        file.seek(at)
        while left > 0:
            data = file.read(min(BLOCK, left))
            if not data:
                return
            left -= len(data)
            yield data


def onward(uri: str, at: int, size: int) -> Iterator[bytes]:
    """The bytes of a range and, for as long as the caller asks, what follows it, in small blocks that grow."""
    yield from blocks(uri, at, size)
    at, step = at + size, min(BLOCK, STEP)
    while data := b"".join(blocks(uri, at, step)):
        yield data
        at, step = at + len(data), min(BLOCK, 4 * step)
