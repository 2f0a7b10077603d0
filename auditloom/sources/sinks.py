"""Table sinks and the checksum audit."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from auditloom.sources import ranges


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Snappy Parquet; ``partition_by`` gives later reads partition pruning.

    Rows are rebalanced by the partition columns first, so a partition is a few files, and a
    large one is split.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of each file; the file contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.col("_metadata.file_name").alias("file"), F.col("length").cast("bigint").alias("bytes")))


def size_report(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Total bytes of both sides and how many times smaller the target is."""
    def total(path: str, name: str) -> DataFrame:
        return file_sizes(spark, path).agg(F.sum("bytes").alias("bytes")).select(F.lit(name).alias("side"), "bytes")

    both = total(source, "source").unionAll(total(target, "target"))
    wide = both.agg(F.max(F.when(F.col("side") == "source", F.col("bytes"))).alias("source_bytes"),
                    F.max(F.when(F.col("side") == "target", F.col("bytes"))).alias("target_bytes"))
    return wide.withColumn("times_smaller", F.expr("try_divide(cast(source_bytes as double), target_bytes)"))


def _digests(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch["path"].to_pylist(), batch["bytes"].to_pylist()):
                digest = hashlib.sha256()
                for data in ranges.blocks(path, 0):
                    digest.update(data)
                yield pa.RecordBatch.from_pydict({"file": [path.rsplit(root, 1)[-1]], "size": [size], "sha256": [digest.hexdigest()]})

    return run


def contents(spark: SparkSession, root: str) -> DataFrame:
    """``file`` (path below ``root``), ``size`` and ``sha256`` of all files under a folder.

    Files are listed without their contents and dealt out one by one; a task reads its file by
    ranges of a few MB, so files of any size are hashed in constant memory. Files without bytes are not listed.
    """
    base = "/" + root.split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
    return ranges.dealt(ranges.listing(spark, root), "path").mapInArrow(_digests(base), "file string, size bigint, sha256 string")


def verify(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Compare ``files`` (``file, size, sha256`` of :func:`contents`, or ``file, size, content``) with a manifest
    of ``file, size, sha256``.

    Contents are hashed in the tasks that read them; only names, sizes and digests
    are joined. ``file`` is a path, so equal base names in two folders stay apart. A
    file missing on either side is kept with a null match.
    """
    digest = F.lower("sha256") if "sha256" in files.columns else F.sha2(F.col("content").cast("binary"), 256)
    found = files.select("file", F.col("size").cast("bigint").alias("actual_size"), digest.alias("actual_sha256"))
    wanted = manifest.select("file", F.col("size").cast("bigint").alias("expected_size"),
                             F.lower("sha256").alias("expected_sha256"))
    joined = found.join(wanted, "file", "full_outer")
    state = (F.when(F.col("actual_sha256").isNull(), F.lit("missing"))
             .when(F.col("expected_sha256").isNull(), F.lit("unlisted"))
             .when((F.col("actual_size") == F.col("expected_size"))
                   & (F.col("actual_sha256") == F.col("expected_sha256")), F.lit("ok"))
             .otherwise(F.lit("changed")))
    return joined.withColumn("state", state)
