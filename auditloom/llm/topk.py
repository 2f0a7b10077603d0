"""Exact top-k by inner product: columnar branch and bound.

Vectors lie in blocks, dimension by dimension. A query adds its products one block of
dimensions after the other; what the rest of the dimensions can still add is at most the
product of the remaining lengths, so candidates below the k-th best lower bound are dropped
and the survivors compacted before the next block. A task keeps a group of candidate blocks and
streams the query blocks, which are stored once; a query's k-th best of the blocks so far cuts
those that follow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from auditloom.llm.common import stored
from auditloom.llm.warc import opened

#: Vectors of a candidate block and of a query block, and dimensions of a step.
CANDIDATES = 2048
QUERIES = 1024
STEP = 16
#: Components that a task holds as candidate blocks, in 8 bytes each.
HELD = 1 << 22

Found = tuple[np.ndarray, np.ndarray]


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> Found:
    """The ``k`` best, ties to smaller ids."""
    order = (np.lexsort((ids, -score)) if score.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i])), np.int64))[:k]
    return ids[order], score[order]


def _top(ids: np.ndarray, vertical: np.ndarray, parts: np.ndarray, query_id: int, query: np.ndarray, k: int, floor: float = -np.inf) -> Found:
    """Ids and scores of the ``k`` best candidates of a block that reach ``floor``."""
    alive = np.flatnonzero(ids != query_id)
    steps = [slice(i, i + STEP) for i in range(0, len(query), STEP)]
    mass = [float((query[s].astype(np.float64) ** 2).sum()) for s in steps]
    score = np.zeros(len(alive), vertical.dtype)
    rest = parts[:, alive].sum(axis=0)
    left = sum(mass)
    for step in np.argsort([-m for m in mass], kind="stable").tolist():
        score = score + query[steps[step]] @ vertical[steps[step]][:, alive]
        left -= mass[step]
        rest = rest - parts[step, alive]
        # Rounding of the lengths is far below one part in a million.
        slack = np.sqrt(max(left, 0.0) * np.maximum(rest, 0.0)) * (1 + 1e-6) + 1e-3 * (left > 0)
        bar = max(floor, np.partition(score - slack, len(alive) - k)[len(alive) - k] if len(alive) > k else floor)
        keep = score + slack >= bar
        if not keep.all():
            alive, score, rest = alive[keep], score[keep], rest[keep]
    return _best(ids[alive], score, k)


class Block:
    """Candidates in vertical layout, with the squared length of each step of dimensions."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vertical = ids, np.ascontiguousarray(vectors.T)
        self.parts = np.array([(self.vertical[i: i + STEP] ** 2).sum(axis=0) for i in range(0, len(self.vertical), STEP)]).reshape(-1, len(ids))
        self.most = float(np.abs(vectors).max(initial=0))

    def top(self, query_id: int, query: np.ndarray, k: int, found: Found | None) -> Found:
        """``found``, the best of the blocks before, with those of this one."""
        most = max(self.most, float(np.abs(query).max(initial=0)))
        if most * most * max(1, len(query)) >= 2.0**53:
            # Beyond the integers that doubles hold: exact Python integers, no bound needed.
            exact = [int(x) for x in query]
            others = np.flatnonzero(self.ids != query_id)
            score = np.empty(len(others), dtype=object)
            score[:] = [sum(a * int(b) for a, b in zip(exact, self.vertical[:, i])) for i in others.tolist()]
            ids = self.ids[others]
        else:
            floor = float(found[1][-1]) if found is not None and len(found[0]) == k and found[1].dtype != object else -np.inf
            ids, score = _top(self.ids, self.vertical, self.parts, query_id, query, k, floor)
        if found is None:
            return _best(ids, score, k)
        if object in (score.dtype, found[1].dtype):
            whole = lambda x: np.array([int(v) for v in x], dtype=object)
            return _best(np.concatenate([found[0], ids]), np.concatenate([whole(found[1]), whole(score)]), k)
        return _best(np.concatenate([found[0], ids]), np.concatenate([found[1], score]), k)


def _query_blocks(files: list[str], dims: int) -> Iterator[tuple[list[int], np.ndarray]]:
    for file in files:
        with opened(file) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=1, columns=["dims", "query_ids", "queries"]):
                if batch["dims"][0].as_py() == dims:
                    asked = batch["query_ids"][0].as_py()
                    yield asked, batch["queries"].flatten().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(asked), dims)


def _search(k: int, files: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["query_id", "vec_id", "score"]
    low, high = -(2**63), 2**63 - 1

    def searched(blocks: list[Block]) -> Iterator[pa.RecordBatch]:
        for asked, queries in _query_blocks(files, len(blocks[0].vertical)):
            found = []
            for query_id, query in zip(asked, queries):
                best = None
                for block in blocks:
                    best = block.top(query_id, query, k, best)
                found.append(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(asked, np.int64), [len(i) for i, _ in found])),
                 pa.array([int(x) for i, _ in found for x in i], pa.int64()),
                 pa.array([min(high, max(low, int(x))) for _, s in found for x in s], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in order of their dimension.
        blocks: list[Block] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> None:
            if waiting:
                ids, vectors = (np.concatenate(x) for x in zip(*waiting))
                blocks.extend(Block(ids[i: i + CANDIDATES], vectors[i: i + CANDIDATES]) for i in range(0, len(ids), CANDIDATES))
                waiting.clear()

        dims, held = None, 0
        for batch in batches:
            ids, flat = batch["vec_id"].to_numpy(zero_copy_only=False), batch["v"].flatten().to_numpy(zero_copy_only=False)
            sizes = batch["dims"].to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if dims is not None and (sizes[lo] != dims or held >= HELD):
                    close()
                    yield from searched(blocks)
                    blocks.clear()
                    held = 0
                dims = int(sizes[lo])
                waiting.append((ids[lo:hi].astype(np.int64), flat[edges[lo]: edges[hi]].reshape(hi - lo, dims)))
                held += dims * (hi - lo)
                if sum(len(i) for i, _ in waiting) >= CANDIDATES:
                    close()
        close()
        if blocks:
            yield from searched(blocks)

    return run


def _query_table(asked: DataFrame) -> DataFrame:
    """Queries packed into blocks of about ``QUERIES`` by a hash of the id, apart by dimension."""
    many = asked.groupBy(F.size("v").alias("dims")).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("many"))
    # As many rows as the table has dimensions: one, as a rule.
    return (asked.withColumn("dims", F.size("v")).join(F.broadcast(many), "dims")
            .groupBy("dims", F.pmod(F.xxhash64("vec_id"), F.col("many")).cast("int").alias("block"))
            .agg(F.collect_list(F.struct("vec_id", "v")).alias("b"))
            .select("dims", F.col("b.vec_id").alias("query_ids"), F.col("b.v").alias("queries")))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``every``, the ``k`` other rows with the highest
    inner product of the vectors ``floor(scale * x)``: ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score``; ties go to the smaller id.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored. Vectors that are
    null or empty, or hold null or non-finite components, and rows with a null id, take no part;
    vectors of different dimension are not compared. Rows with the query's id are its own; of
    queries with one id the smallest vector asks. Components and scores beyond 64 bits are clipped to them.
    """
    rows = (vectors.where("vec_id IS NOT NULL AND size(embedding) > 0")
            .where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
            .select(F.col("vec_id").cast("bigint").alias("vec_id"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v")))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    files = stored(_query_table(asked), "queries").inputFiles()
    # A task's share is what it holds at once, or less where that leaves cores idle.
    spark = vectors.sparkSession
    components = rows.agg(F.sum(F.size("v"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-components // HELD))
    dealt = rows.withColumn("dims", F.size("v")).repartition(tasks, F.xxhash64("vec_id", "v")).sortWithinPartitions("dims")
    found = dealt.mapInArrow(_search(k, files), "query_id bigint, vec_id bigint, score bigint")
    rank = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)").cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
