"""Helpers of the operators in this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from auditloom.session import durable, ensure_checkpoint_dir

__all__ = ["apart", "durable", "sampled_ids", "scratch", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut, and its
    size known to the planner."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def apart(documents: DataFrame) -> DataFrame:
    """``documents`` with all columns but ``doc_id`` and ``text`` named by their place, so that none of them clashes with a
    helper column; ``.toDF(*documents.columns)`` gives the names back."""
    return documents.toDF(*[c.lower() if c.lower() in ("doc_id", "text") else f"column {i}" for i, c in enumerate(documents.columns)])


#: No sample has more ids than this.
SAMPLE_IDS = 50_000


def sampled_ids(rows: DataFrame, label: str, most: int | dict) -> DataFrame:
    """Distinct ``doc_id`` of at most ``most`` rows of each value of ``label`` (a dict: of each of its keys),
    by the hash of the id, and of ``SAMPLE_IDS`` in all (many labels share it evenly), so the result
    may be broadcast.

    Counts come first, then a threshold on the hash that leaves about twice as many rows, and
    only those are ranked: what is ranked does not grow with the table. Null ids and labels are
    never chosen.
    """
    rows = rows.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", label)
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    share = SAMPLE_IDS // max(1, len(counts))
    bounds = {k: min(share, most if isinstance(most, int) else most.get(k, 0)) for k in counts}
    if not counts:
        return rows.select("doc_id")
    rates = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, (2.0 * bounds[k] + 100) / n)))
    limits = F.create_map(*(F.lit(x) for k, n in bounds.items() for x in (k, n)))
    thin = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < rates[F.col(label)] * float(1 << 40))
    ranked = thin.withColumn("_at", F.expr(f"row_number() OVER (PARTITION BY {label} ORDER BY xxhash64(doc_id), doc_id)"))
    return durable(ranked.where(F.col("_at") <= limits[F.col(label)]).select("doc_id").distinct())
