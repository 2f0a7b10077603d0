"""Connected components by large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from auditloom.llm.common import durable


#: Edges that one task of a round holds.
EDGES_PER_TASK = 200_000


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``: the smallest node that each node of ``edges`` (columns
    ``a``, ``b``) reaches. Nodes without an edge are absent. Every round is checkpointed; the
    driver sees only one count and one sum per round. A node's neighbours are never gathered:
    each round takes a minimum per node and joins it back.
    """
    edges = durable(_down(edges))
    last, rows = None, edges.count()
    while True:
        # Tasks follow the edges that are left: a round of few edges writes few shuffle and checkpoint files.
        tasks = rows // EDGES_PER_TASK + 1
        edges = durable(_small(_large(edges, tasks), tasks).coalesce(tasks))
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last, rows = mark, mark[0]
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _down(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct edges from the smaller node ``a`` to the larger ``b``."""
    down = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return (down.coalesce(tasks) if tasks else down).distinct()


def _large(edges: DataFrame, tasks: int) -> DataFrame:
    """Links each node's larger neighbours to the smallest node around it."""
    low = edges.groupBy(F.col("b").alias("m")).agg(F.min("a").alias("low"))
    # A node without a smaller neighbour is the smallest of its own: those edges stay.
    moved = edges.join(low, edges["a"] == low["m"], "left")
    return _down(moved.select(F.coalesce("low", "a").alias("a"), "b")
                 .unionByName(low.select(F.col("low").alias("a"), F.col("m").alias("b"))), tasks)


def _small(edges: DataFrame, tasks: int) -> DataFrame:
    """Links each node's smaller neighbours, and the node, to the smallest of them."""
    low = edges.groupBy("b").agg(F.min("a").alias("low"))
    moved = edges.join(low, "b").select(F.col("low").alias("x"), F.col("a").alias("y"))
    return _down(moved.select(F.col("x").alias("a"), F.col("y").alias("b"))
                 .unionByName(low.select(F.col("low").alias("a"), "b")), tasks)
