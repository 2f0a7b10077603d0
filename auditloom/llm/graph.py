"""Approximate nearest neighbours: a neighbour graph by NN-descent, queries by greedy graph search.

1. Equal vectors are one node with its smallest ids, so a vector of a third of all rows is a node
   like others and does not fill its copies' lists.
2. Descent starts from groups of nodes on the same side of random planes. Then each round brings
   together, at every node, those it lists and those that list it; where one of a pair is
   new to the node the pair is measured, and kept where it is among the best ``DEGREE`` of one of the two.
   Rounds are Spark joins and go on while lists still change. Nodes that very many others list
   meet those in chunks.
3. A query is a pool of the ``POOL`` nearest nodes seen. Each round sends the unopened ones' neighbours
   to the part of the index that holds them, which measures them and returns those that can
   enter the pool together with their own neighbours; it ends when all of the pool are opened.
4. What is found is measured again on the original vectors in double precision.

Vectors are compared as float32 in the graph, measured in double.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from auditloom.llm.common import stored

#: Neighbours of a node in the graph; members of a starting group; times nodes are dealt to starting groups.
DEGREE = 20
GROUP = 96
STARTS = 8
#: Descent ends when a round changes fewer than this share of all list places.
STILL = 0.05
#: Nearest nodes that a query keeps, and nodes that it opens a round.
POOL = 512
OPEN = 256
#: Nodes of one part of the index.
PART = 32768
#: Candidate rows that a task holds before it cuts them to the best of each node.
HELD = 1 << 20


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that come ordered by ``keys``, in tables that never part a key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        cut = len(batch)
        last = [batch[k][len(batch) - 1] for k in keys]
        while cut and all(batch[k][cut - 1] == v for k, v in zip(keys, last)):
            cut -= 1
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and any(held[0][k][0] != v for k, v in zip(keys, last)):
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _starts(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)])) if len(values) else np.zeros(1, np.int64)


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the length of each list."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    return np.asarray(column.flatten()), lengths


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(values))


def _best(node: np.ndarray, other: np.ndarray, far: np.ndarray, fresh: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` nearest of each node, each other node once (an old entry before a new one), nodes
    in order and nearest first."""
    by = np.lexsort((fresh, far, other, node))
    again = np.zeros(len(by), bool)
    again[1:] = (node[by][1:] == node[by][:-1]) & (other[by][1:] == other[by][:-1])
    by = by[~again]
    by = by[np.lexsort((other[by], far[by], node[by]))]
    edges = _starts(node[by])
    place = np.arange(len(by)) - np.repeat(edges[:-1], np.diff(edges))
    return by[place < k]


def _meet(k: int) -> Callable:
    """Pairs of the members of each centre, the best ``k`` of each member."""
    names = ["node", "ids", "far"]

    def cut(parts: list[tuple]) -> tuple:
        node, other, far = (np.concatenate(c) for c in zip(*parts))
        at = _best(node, other, far, np.zeros(len(node), np.int8), k)
        return node[at], other[at], far[at]

    def batch(parts: list[tuple]) -> pa.RecordBatch:
        node, other, far = cut(parts)
        edges = _starts(node)
        return pa.RecordBatch.from_arrays([pa.array(node[edges[:-1]]), _lists(other, np.diff(edges)), _lists(far, np.diff(edges))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        held = 0
        for table in _grouped(batches, ["centre", "chunk"]):
            centre, chunk, member = (table[c].to_numpy() for c in ("centre", "chunk", "member"))
            fresh, bound = table["fresh"].to_numpy(zero_copy_only=False), table["bound"].to_numpy()
            flat, lengths = _flat(table["v"])
            ends = np.concatenate(([0], np.cumsum(lengths)))
            edges = np.union1d(_starts(centre), _starts(chunk))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                # A member that lists the centre and is listed by it comes twice; new if either is.
                ids, at = np.unique(member[a:b], return_index=True)
                if len(ids) < 2:
                    continue
                new = np.isin(ids, member[a:b][fresh[a:b]])
                if not new.any():
                    continue
                x = flat[ends[a]: ends[b]].reshape(b - a, -1)[at].astype(np.float64)
                at += a
                x -= x[0]
                square = (x * x).sum(axis=1)
                far = np.maximum(square[:, None] + square[None] - 2 * (x @ x.T), 0)
                ok = (new[:, None] | new[None]) & (far < bound[at][:, None])
                np.fill_diagonal(ok, False)
                i, j = np.nonzero(ok)
                if len(i):
                    parts.append((ids[i], ids[j], far[i, j]))
                    held += len(i)
                if held > HELD:
                    parts = [cut(parts)]
                    held = len(parts[0][0])
                    if held > HELD // 2:
                        yield batch(parts)
                        parts, held = [], 0
        if parts:
            yield batch(parts)

    return run


def _merge(k: int) -> Callable:
    """Lists of each node with what the round found. ``fresh`` marks what the list did not hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ["node"]):
            node, old = table["node"].to_numpy(), table["old"].to_numpy(zero_copy_only=False)
            other, lengths = _flat(table["ids"])
            far, _ = _flat(table["far"])
            owner = np.repeat(node, lengths)
            fresh = np.repeat(~old, lengths).astype(np.int8)
            at = _best(owner, other, far, fresh, k)
            owner, other, far, fresh = owner[at], other[at], far[at], fresh[at].astype(bool)
            nodes = node[old]
            lengths = np.searchsorted(owner, nodes, side="right") - np.searchsorted(owner, nodes)
            last = np.cumsum(lengths) - 1
            bound = np.where(lengths >= k, far[np.maximum(last, 0)] if len(far) else np.inf, np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), table["v"].combine_chunks().filter(pa.array(old)), _lists(other, lengths), _lists(far, lengths), _lists(fresh, lengths), pa.array(bound)],
                names=["node", "v", "ids", "far", "fresh", "bound"])

    return run


_STATE = "node bigint, v array<float>, ids array<bigint>, far array<double>, fresh array<boolean>, bound double"


def _round(members: DataFrame, state: DataFrame, k: int) -> DataFrame:
    """The state after the members of each (``centre``, ``chunk``) have met."""
    met = members.repartition("centre", "chunk").sortWithinPartitions("centre", "chunk").mapInArrow(_meet(k), "node bigint, ids array<bigint>, far array<double>")
    none = F.lit(None)
    both = (state.select("node", F.lit(True).alias("old"), "v", "ids", "far")
            .unionByName(met.select("node", F.lit(False).alias("old"), none.cast("array<float>").alias("v"), "ids", "far")))
    return stored(both.repartition("node").sortWithinPartitions("node", F.desc("old")).mapInArrow(_merge(k), _STATE), "graph-state")


def _sides(planes: np.ndarray, offsets: np.ndarray, starts: int) -> Callable:
    """Per node and start: the side of each plane, as bits."""
    bits = len(offsets) // starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, lengths = _flat(batch["v"])
            ends = np.cumsum(lengths)
            keys = np.zeros((len(batch), starts), np.int64)
            for dims in np.unique(lengths):
                rows = np.flatnonzero(lengths == dims)
                x = flat[(ends[rows] - dims)[:, None] + np.arange(dims)].astype(np.float64)
                # Vectors of other dimension than the planes' take the part that they have.
                d = min(int(dims), planes.shape[1])
                above = (x[:, :d] @ planes[:, :d].T > offsets).reshape(len(rows), starts, bits)
                keys[rows] = (above << np.arange(bits)).sum(axis=2) if bits else 0
            yield pa.RecordBatch.from_arrays([batch["node"], batch["v"], pa.array(lengths.astype(np.int32)), _lists(keys.ravel(), np.full(len(batch), starts))],
                                             names=["node", "v", "dims", "keys"])

    return run


def neighbour_graph(nodes: DataFrame, degree: int = DEGREE, starts: int = STARTS) -> DataFrame:
    """``nodes`` (``node`` bigint, unique, and ``v`` array<float>) with the ``ids`` of about the ``degree`` nearest other
    nodes of the same dimension, nearest first, and their squared distances ``far``.

    Every node of a dimension with more nodes gets neighbours. An empty table gives none.
    """
    total = nodes.count()
    bits = max(0, int(math.log2(max(1, total / GROUP))))
    # The planes halve pairs of nodes; as many as planes are read, whatever the table's size.
    ends = [np.array(r["v"], np.float64) for r in nodes.orderBy(F.xxhash64("v")).select("v").limit(2 * starts * bits).collect()] if bits else []
    width = max((len(e) for e in ends), default=1)
    ends = [np.pad(e, (0, width - len(e))) for e in ends]
    pairs = [(ends[2 * i % len(ends)], ends[(2 * i + 1) % len(ends)]) for i in range(starts * bits)]
    planes = np.array([a - b for a, b in pairs]).reshape(-1, width)
    offsets = np.array([(a @ a - b @ b) / 2 for a, b in pairs])
    keyed = nodes.mapInArrow(_sides(planes, offsets, starts), "node bigint, v array<float>, dims int, keys array<bigint>")
    # The last start is by chance alone: no node stays without a group of about GROUP.
    keyed = keyed.withColumn("keys", F.concat("keys", F.array(F.lit(0).cast("bigint"))))
    placed = stored(keyed.select("node", "v", "dims", F.posexplode("keys").alias("start", "key")), "graph-starts")
    sizes = placed.groupBy("dims", "start", "key").agg(F.ceil(F.count("*") / GROUP).alias("chunks"))
    members = (placed.join(sizes, ["dims", "start", "key"])
               .select(F.xxhash64("dims", "start", "key").alias("centre"), F.pmod(F.xxhash64("node", "start"), "chunks").cast("int").alias("chunk"),
                       F.col("node").alias("member"), F.lit(True).alias("fresh"), F.lit(float("inf")).alias("bound"), "v"))
    none = F.array()
    state = nodes.select("node", "v", none.cast("array<bigint>").alias("ids"), none.cast("array<double>").alias("far"))
    state = _round(members, state, degree)
    while True:
        changed = state.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        if changed <= STILL * degree * total:
            return state
        lists = state.select("node", "bound", F.explode(F.arrays_zip("ids", "fresh")).alias("e")).select("node", "bound", F.col("e.ids").alias("id"), F.col("e.fresh").alias("fresh"))
        # Centres with something new, and the chunks of those that list them.
        crowd = lists.groupBy(F.col("id").alias("centre")).agg(F.count("*").alias("n"), F.max("fresh").alias("new"))
        own = state.select(F.col("node").alias("centre"), F.exists("fresh", lambda x: x).alias("mine"))
        centres = (own.join(crowd, "centre", "left").where("mine OR new")
                   .select("centre", F.greatest(F.lit(1), F.ceil(F.coalesce("n", F.lit(0)) / (2 * degree))).cast("int").alias("chunks")))
        centres = stored(centres, "graph-centres")
        # Those that list a centre bring their vector along; for those it lists it is joined.
        back = (state.select("node", "v", "bound", F.explode(F.arrays_zip("ids", "fresh")).alias("e"))
                .select(F.col("e.ids").alias("centre"), F.col("node").alias("member"), F.col("e.fresh").alias("fresh"), "bound", "v").join(centres, "centre")
                .withColumn("chunk", F.pmod(F.xxhash64("member"), "chunks").cast("int")).drop("chunks"))
        ahead = (lists.select(F.col("node").alias("centre"), F.col("id").alias("member"), "fresh").join(centres, "centre")
                 .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
                 .join(state.select(F.col("node").alias("member"), "v", "bound"), "member"))
        state = _round(back.unionByName(ahead), state, degree)


_ASKED = ["part", "kind", "node", "v", "ids", "links", "q", "bound"]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per request: the asked nodes that can enter the query's pool, and their neighbours.

    Rows come by part of the index, its nodes (kind 0) before the requests (kind 1), which stream past them.
    """
    part, nodes, vectors, links = None, {}, [], []
    for batch in batches:
        parts, kinds, queries = (np.asarray(batch[c]) for c in ("part", "kind", "q"))
        out = []
        for row in range(len(batch)):
            if parts[row] != part:
                part, nodes, vectors, links = parts[row], {}, [], []
            v = np.asarray(batch["v"][row].values)
            if kinds[row] == 0:
                nodes[batch["node"][row].as_py()] = len(vectors)
                vectors.append(v)
                links.append(np.asarray(batch["links"][row].values))
                continue
            at = [k for k in map(nodes.get, batch["ids"][row].as_py()) if k is not None and len(vectors[k]) == len(v)]
            if at:
                far = ((np.array([vectors[k] for k in at], np.float64) - v) ** 2).sum(axis=1)
                near = np.flatnonzero(far < batch["bound"][row].as_py())
                if len(near):
                    out.append((queries[row], near, far[near], at))
        if out:
            names = list(nodes)
            ids = np.array([names[at[k]] for _, near, _, at in out for k in near.tolist()], np.int64)
            to = [links[at[k]] for _, near, _, at in out for k in near.tolist()]
            sizes = np.array([len(o[1]) for o in out])
            inner = _lists(np.concatenate(to), np.array([len(x) for x in to]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), _lists(ids, sizes), _lists(np.concatenate([o[2] for o in out]), sizes),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), inner)], names=["q", "ids", "far", "links"])


def _advance(pool: int, opens: int) -> Callable:
    """A query's pool with what its requests found (``kind`` 0: the pool), and the nodes to ask for next.

    ``ids``, ``far``, ``links`` of the pool are nearest first; a node whose neighbours were asked for has none left.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ["q"]):
            q, kind = table["q"].to_numpy(), table["kind"].to_numpy()
            ids, far = table["ids"].to_pylist(), table["far"].to_pylist()
            links, vectors = table["links"].combine_chunks(), table["v"].combine_chunks()
            edges = _starts(q).tolist()
            out: dict[str, list] = {c: [] for c in ("q", "v", "ids", "far", "links", "ask", "bound")}
            for a, b in zip(edges[:-1], edges[1:]):
                first = a + int(np.argmin(kind[a:b]))
                seen: dict[int, tuple] = {}
                for r in [first] + [r for r in range(a, b) if r != first]:
                    for i, d, x in zip(ids[r], far[r], links[r].as_py()):
                        if i not in seen:
                            seen[i] = (d, i, x)
                best = sorted(seen.values(), key=lambda e: e[:2])[:pool]
                mine = {e[1] for e in best}
                ask: set[int] = set()
                opened = 0
                for k, (d, i, x) in enumerate(best):
                    # A query asks for something as long as it has an unopened node that leads on.
                    if x and (opened < opens or not ask):
                        ask.update(j for j in x if j not in mine)
                        best[k] = (d, i, [])
                        opened += 1
                for c, v in (("q", int(q[a])), ("v", vectors[first].as_py()), ("ids", [e[1] for e in best]), ("far", [e[0] for e in best]), ("links", [e[2] for e in best]),
                             ("ask", sorted(ask)), ("bound", best[-1][0] if len(best) == pool else float("inf"))):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_POOL_ARROW)

    return run


_POOL = "q bigint, v array<float>, ids array<bigint>, far array<double>, links array<array<bigint>>, ask array<bigint>, bound double"
_POOL_ARROW = pa.schema([("q", pa.int64()), ("v", pa.list_(pa.float32())), ("ids", pa.list_(pa.int64())), ("far", pa.list_(pa.float64())),
                         ("links", pa.list_(pa.list_(pa.int64()))), ("ask", pa.list_(pa.int64())), ("bound", pa.float64())])


def linked(graph: DataFrame, degree: int = DEGREE) -> DataFrame:
    """``node``, ``v`` and ``links`` of each node: those it lists, and the ``degree`` nearest of those that list it."""
    edges = graph.select("node", F.explode(F.arrays_zip("ids", "far")).alias("e")).select("node", F.col("e.ids").alias("id"), F.col("e.far").alias("far"))
    near = edges.withColumn("at", F.expr("row_number() OVER (PARTITION BY id ORDER BY far, node)")).where(F.col("at") <= degree)
    back = near.groupBy(F.col("id").alias("node")).agg(F.collect_list("node").alias("back"))
    return graph.join(back, "node", "left").select("node", "v", F.array_distinct(F.concat("ids", F.coalesce("back", F.array().cast("array<bigint>")))).alias("links"))


def search(index: DataFrame, queries: DataFrame, pool: int = POOL, opens: int = OPEN) -> DataFrame:
    """The up to ``pool`` nearest nodes of ``index`` (``node``, ``v``, ``links``) that a greedy walk finds for each of
    ``queries`` (``q`` bigint, unique, ``v``, ``entry``: nodes to start from): ``q``, ``ids``, ``far`` (squared),
    nearest first.

    A round is one join with the index and one with the pools; each query opens up to ``opens`` nodes in it.
    The rounds end when no pool has an unopened node, as every round opens one a query or ends it.
    """
    parts = max(1, index.count() // PART)
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    none = lambda kind: F.lit(None).cast(kind)
    index = stored(index.withColumn("part", part("node")), "graph-index")
    held = index.select("part", F.lit(0).alias("kind"), "node", "v", none("array<bigint>").alias("ids"), "links", none("bigint").alias("q"), none("double").alias("bound"))
    empty = F.array()
    pools = queries.select("q", "v", empty.cast("array<bigint>").alias("ids"), empty.cast("array<double>").alias("far"), empty.cast("array<array<bigint>>").alias("links"),
                           F.array_distinct("entry").alias("ask"), F.lit(float("inf")).alias("bound"))
    pools = stored(pools, "graph-pools")
    while not pools.where("size(ask) > 0").isEmpty():
        asked = (pools.select("q", "v", "bound", F.explode("ask").alias("id")).withColumn("part", part("id"))
                 .groupBy("part", "q").agg(F.collect_list("id").alias("ids"))
                 .join(pools.select("q", "v", "bound"), "q")
                 .select("part", F.lit(1).alias("kind"), none("bigint").alias("node"), "v", "ids", none("array<bigint>").alias("links"), "q", "bound"))
        met = held.unionByName(asked).repartition("part").sortWithinPartitions("part", "kind").select(*_ASKED)
        answers = met.mapInArrow(_measure, "q bigint, ids array<bigint>, far array<double>, links array<array<bigint>>")
        both = (pools.select("q", F.lit(0).alias("kind"), "v", "ids", "far", "links")
                .unionByName(answers.select("q", F.lit(1).alias("kind"), none("array<float>").alias("v"), "ids", "far", "links")))
        pools = stored(both.repartition("q").sortWithinPartitions("q").mapInArrow(_advance(pool, opens), _POOL), "graph-pools")
    return pools.select("q", "ids", "far")


def distance(a: str, b: str):
    """Euclidean distance in double precision, component after component."""
    return F.expr(f"sqrt(aggregate(zip_with({a}, {b}, (x, y) -> (double(x) - double(y)) * (double(x) - double(y))), 0D, (t, s) -> t + s))")


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, degree: int = DEGREE, pool: int = POOL) -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``every``, about the ``k`` other rows at the smallest Euclidean
    distance: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (exact, in double precision), ties to the smaller id.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored. Vectors that are null, empty or zero, or
    hold null or non-finite components, and rows with a null id, take no part; vectors of different dimension
    are not compared. Rows with the query's id are its own; of queries with one id the smallest vector asks.
    Equal rows count once. An empty table gives no rows, and a query without candidates none.
    Components beyond 3e38 count as that in the graph; the score is of the original vectors.
    """
    rows = (vectors.where("vec_id IS NOT NULL AND size(embedding) > 0")
            .where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
            .where(F.exists("embedding", lambda x: x != 0)).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("x")))
    # The ids of equal vectors: a query needs its k nearest and may itself be one of them.
    ranked = rows.withColumn("at", F.expr("dense_rank() OVER (PARTITION BY x ORDER BY vec_id)"))
    nodes = ranked.where(F.col("at") <= k + 1).groupBy("x").agg(F.sort_array(F.collect_set("vec_id")).alias("members"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("v", F.transform("x", lambda x: F.greatest(F.least(x.cast("double"), F.lit(3e38)), F.lit(-3e38)).cast("float"))), "graph-nodes")
    graph = neighbour_graph(nodes.select("node", "v"), degree)

    asks = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x")).join(nodes.select("x", "node"), "x").select(F.col("vec_id").alias("query_id"), "node")
    asks = stored(asks, "graph-asks")
    # Rows of one vector ask once.
    queries = asks.select(F.col("node").alias("q")).distinct().join(graph.select(F.col("node").alias("q"), "v"), "q").withColumn("entry", F.array("q"))
    found = search(linked(graph, degree), queries, pool)
    exact = (found.select("q", F.explode("ids").alias("node")).join(nodes.select("node", "members", "x"), "node")
             .join(nodes.select(F.col("node").alias("q"), F.col("x").alias("y")), "q").select("q", "members", distance("x", "y").alias("score")))
    exact = exact.withColumn("at", F.expr("row_number() OVER (PARTITION BY q ORDER BY score, members[0])")).where(F.col("at") <= k + 1)
    rank = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)").cast("int")
    return (asks.join(exact.select(F.col("q").alias("node"), F.explode("members").alias("vec_id"), "score"), "node").where("vec_id != query_id")
            .withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
