from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pytest

from auditloom.llm import graph
from auditloom.llm.common import table


def brute(data, k=10, every=100):
    """``data``: (vec_id, vector). Rows of ``nearest`` by its definition, as {query_id: [(vec_id, score)]}."""
    rows = sorted({(i, tuple(v)) for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, v in rows:
        if i % every == 0 and i not in out:
            scored = sorted((math.sqrt(reduce(lambda t, p: t + p, ((a - b) * (a - b) for a, b in zip(v, w)), 0.0)), j) for j, w in rows if j != i and len(w) == len(v))
            if scored:
                out[i] = [(j, s) for s, j in scored[:k]]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in data], "vec_id bigint, embedding array<float>, node int, q int, rank string").repartition(3)


def recall(got, want):
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    return hits / sum(map(len, want.values()))


def test_awkward_rows_are_found_exactly(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 6)]) for i in range(230)]
    hot = data[40][1]
    data += [(1000 + i, hot) for i in range(150)] + [(300, data[3][1]), (300, data[3][1]), (301, hot), (301, hot)]
    data += [(None, hot), (400, None), (500, []), (600, [0.0] * 6), (700, [float("nan")] * 6), (800, [None] * 6), (900, [float("inf")] * 6),
             (2000, [1.0, 2.0]), (2001, [1.0, 2.5]), (2100, [1.0]), (-100, [float(np.float32(1e30))] * 6), (-200, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0])]
    got, want = found(graph.nearest(frame(spark, data)).collect()), brute(data)
    assert got.keys() == want.keys() and recall(got, want) == 1.0
    assert got == want
    assert graph.nearest(frame(spark, data).where("false")).count() == 0
    assert graph.nearest(frame(spark, [(0, [1.0, 1.0])])).count() == 0


def test_recall_against_brute_force(spark, folder):
    for name in (folder, folder.replace("sf0.001", "sf0.1")):
        vectors = table(spark, name, "embeddings").select("vec_id", "embedding")
        data = [(r[0], r[1]) for r in vectors.collect()]
        got, want = found(graph.nearest(vectors).collect()), brute(data)
        assert got.keys() == want.keys() and recall(got, want) >= 0.98
        exact = {q: dict(x) for q, x in brute(data, k=len(data)).items()}
        assert all(s == exact[q][i] for q, some in got.items() for i, s in some)


def test_groups_are_not_parted():
    rows = [(a, b) for a, n in ((1, 3), (2, 1), (3, 7), (4, 2)) for b in range(n)]
    for size in (1, 2, 3, 5, 20):
        batches = [pa.RecordBatch.from_pydict({"k": [r[0] for r in rows[i: i + size]], "x": [r[1] for r in rows[i: i + size]]}) for i in range(0, len(rows), size)]
        seen, order = [], []
        for t in graph._grouped(iter(batches), ["k"]):
            keys = set(t["k"].to_pylist())
            assert not keys & set(seen)
            seen += keys
            order += list(zip(t["k"].to_pylist(), t["x"].to_pylist()))
        assert order == rows


@pytest.mark.parametrize("k", [1, 3])
def test_best_keeps_the_nearest_of_each_node_once(k):
    rng = np.random.default_rng(k)
    node, other, far = rng.integers(0, 5, 200), rng.integers(0, 9, 200), rng.random(200).astype(np.float32)
    at = graph._best(node, other, far, np.zeros(200, np.int8), k)
    want = []
    for n in range(5):
        least = {}
        for o, d in zip(other[node == n].tolist(), far[node == n].tolist()):
            least[o] = min(d, least.get(o, d))
        want += [(n, o, d) for o, d in sorted(least.items(), key=lambda e: e[1])[:k]]
    assert list(zip(node[at].tolist(), other[at].tolist(), far[at].tolist())) == want
