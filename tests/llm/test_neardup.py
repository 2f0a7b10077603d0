from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

import rows
from auditloom.llm import neardup
from auditloom.llm.components import components
from auditloom.llm.words import WordHasher

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[i: i + width]) for i in range(len(words) - width + 1))


def brute(data, width, percent=80):
    sets = [shingles(t, width) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(data):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(data, sets))), key=str)


def test_words_are_hashed_alike_wherever_they_stand():
    hasher = WordHasher(neardup.SPACES)
    words, at = hasher(pa.array(["The cat", None, "", " the\tCAT\n", "cat" + "x" * 600000 + " the"]))
    assert at.tolist() == [0, 2, 2, 2, 4, 6]
    assert words[0] == words[2] == words[5] and words[1] == words[3] and words[4] not in words[:4]


def test_a_signature_agrees_as_often_as_the_sets_overlap():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 900, np.uint64)
    agree = (neardup.signature(x[:800]) == neardup.signature(x[100:])).mean()
    assert abs(agree - 700 / 900) < 0.1


def test_pruning_bound():
    least = neardup.least_matches(0.8, 1e-6)
    assert len(least) == neardup.HASHES // neardup.BATCH and all(a < b for a, b in zip(least, least[1:]))
    rng = np.random.default_rng(5)
    misses = sum((rng.random((200, n)) < 0.8).sum(axis=1).min() < m for n, m in zip(range(32, 257, 32), least))
    assert misses == 0 and least[-1] > 0.6 * neardup.HASHES


@pytest.mark.parametrize("width", [2, 5])
def test_groups_match_brute_force(spark, width):
    data = rows.DOCUMENTS + [(100 + k, rows.sentence(k % 7, 40 + k % 5)) for k in range(60)]
    for k in range(25):
        words = rows.sentence(77, 60).split()
        words[k] = f"odd{k}"
        words[(3 * k) % 60] = f"even{k}"
        data.append((300 + k, " ".join(words)))
    got = neardup.near_duplicates(rows.documents(spark, data), width).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = brute(data, width)
    assert sorted(((r[0], r[1], r[2] if r[1] else r[0], r[3]) for r in got if r[0] is not None), key=str) == [
        (d, n, c if n else d, k) for d, n, c, k in want if d is not None]
    assert len(got) == len(data)


def test_one_of_each_group_stays(spark):
    docs = rows.documents(spark)
    kept = neardup.without_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15, 16] and ids.count(None) == 2


def test_empty_table(spark):
    assert neardup.near_duplicates(rows.documents(spark, [])).count() == 0
    assert neardup.without_duplicates(rows.documents(spark, [(1, None), (1, None)])).count() == 1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert {found[k] for k in range(41)} == {0} and {found[k] for k in range(100, 140)} == {100}


def test_a_pair_is_skipped_only_where_an_earlier_bucket_had_it():
    sig = np.arange(neardup.HASHES, dtype=np.uint16).tobytes()

    def pairs(past):
        group = pa.table({"sig": pa.array([sig, sig], pa.binary()), "comp": pa.array([b"a", b"b"], pa.binary()), "side": [0, 0], "lo": [0, 0], "hi": [0, 0],
                          "band": [2, 2], "past": pa.array(past, pa.list_(pa.int64()))})
        return [(i, js.tolist()) for i, js in neardup._Block(group, neardup.least_matches(0.8, 1e-6)).pairs()]

    assert pairs([[1, 2], [3, 4]]) == [(0, [1])] and pairs([[1, 2], [3, 2]]) == []
