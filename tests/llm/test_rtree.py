from __future__ import annotations

import numpy as np
import pytest

from auditloom.llm import rtree


def brute(data, every=100, positives=5, negatives=10, scale=256):
    """``data``: (vec_id, vector, label), ids distinct among anchors."""
    rows = [(i, [int(np.floor(scale * x)) for x in v], c) for i, v, c in data
            if i is not None and c is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v, c in rows:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j, d) for j, w, d in rows if j != i and len(w) == len(v))
            for s, j, _ in [r for r in scored if r[2] == c][:positives]:
                fit = [(t, n) for t, n, d in scored if d != c and 30 * -s <= 100 * -t <= 90 * -s][:negatives]
                out += [(i, j, k + 1, n, -s, -t) for k, (t, n) in enumerate(fit)]
    return sorted(out)


def frame(spark, data):
    return spark.createDataFrame([(i, v, c, 7, "x") for i, v, c in data], "vec_id bigint, embedding array<float>, label int, tile int, rank string").repartition(4)


def awkward(rng, n, dims, spread):
    data = [(i, [float(np.float32(x)) for x in rng.normal(0.2, spread, dims)], int(rng.integers(4))) for i in range(n)]
    hot = data[5][1]
    data += [(1000 + i, hot, i % 2) for i in range(n // 2)]
    data += [(100, data[100][1], 3)] if n > 100 else []
    return data + [(None, hot, 1), (2100, None, 1), (2200, [], 1), (2300, [float("nan")] * dims, 1), (2400, [None] * dims, 1), (2500, hot, None),
                   (2600, [float("inf")] * dims, 1), (2700, [0.0] * dims, 1), (2800, [0.5], 1), (2801, [0.75], 1), (2802, [0.25], 2), (-100, hot, 2)]


@pytest.mark.parametrize("n, dims, spread, tile", [(300, 8, 0.3, 64), (90, 3, 1e6, 32), (200, 40, 0.2, 8192)])
def test_matches_brute_force(spark, monkeypatch, n, dims, spread, tile):
    monkeypatch.setattr(rtree, "TILE", tile)
    monkeypatch.setattr(rtree, "REQUESTS", 2)
    data = [r for r in awkward(np.random.default_rng(n), n, dims, spread) if r[0] != 100 or r[2] != 3]
    assert sorted(map(tuple, rtree.hard_negatives(frame(spark, data)).collect())) == brute(data)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(k, [0.1 * k, 1.0], k % 2) for k in range(0, 12)] * 2
    got = [tuple(r) for r in rtree.hard_negatives(frame(spark, rows)).collect()]
    assert len(got) == 0 or all(r[1] != r[0] for r in got)
    assert rtree.hard_negatives(frame(spark, rows).where("false")).count() == 0
    alone = [(0, [1.0, 1.0], 1), (1, [1.0, 0.0], 2)]
    assert rtree.hard_negatives(frame(spark, alone)).count() == 0


def test_boxes_hold_their_rows_and_searches_open_few():
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(0, 100, (4000, 4)))
    ids, labels = np.arange(4000), rng.integers(0, 3, 4000)
    tree = rtree.Tree(ids, labels, vectors, leaf=16, fanout=4)
    assert sorted(tree.ids.tolist()) == ids.tolist() and max(s.stop - s.start for s in tree.leaves) <= 16
    for box, rows in enumerate(tree.leaves):
        assert (tree.vectors[rows] >= tree.low[box]).all() and (tree.vectors[rows] <= tree.high[box]).all()
    anchor = vectors[7]
    least, most = tree.intervals(anchor[None])
    scores = tree.vectors @ anchor
    for box, rows in enumerate(tree.leaves):
        assert least[0][box] <= scores[rows].min() and most[0][box] >= scores[rows].max()
    seen = []
    leaves = tree.leaves
    tree.leaves = type("Counted", (list,), {"__getitem__": lambda self, k: (seen.append(k), list.__getitem__(self, k))[1]})(leaves)
    found = tree.search(7, anchor, int(labels[7]), True, [[rtree._LOW, rtree._HIGH, rtree._LOW]], least[0].tolist(), most[0].tolist(), 5)[0]
    want = sorted((-s, i) for s, i, c in zip(scores.tolist(), tree.ids.tolist(), tree.labels.tolist()) if c == labels[7] and i != 7)[:5]
    assert found == want and len(set(seen)) < len(leaves) / 3
