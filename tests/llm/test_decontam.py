from __future__ import annotations

import numpy as np
import pytest

import rows
from auditloom.llm import decontam
from auditloom.llm.fmindex import FMIndex

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [(1, rows.PASSAGE), (2, "alone"), (3, None), (4, "!!"), (5, rows.sentence(5, 12)), (6, rows.PASSAGE), (None, "mail"), (7, "not in there")]


def words_of(text):
    return decontam.WORD.findall((text or "").translate(LOWER))


def brute(data, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for k in range(max(1, len(words) - 9) if words and item is not None else 0):
            windows.setdefault(tuple(words[k: k + 10]), set()).add(str(item))
    out = []
    for doc_id, text in data:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k: k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(words[k: k + size])]
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_index_finds_all_places():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 3000)
    fm = FMIndex(text, 3)
    for size in (1, 2, 3, 7):
        for _ in range(20):
            at = int(rng.integers(0, 2990))
            pattern = text[at: at + size]
            want = [i for i in range(3000 - size + 1) if (text[i: i + size] == pattern).all()]
            which, lo, hi = fm.search(pattern[None, :], np.array([size]))
            if (pattern == 0).any():
                continue
            assert len(which) == 1 and sorted(fm.locate(np.arange(lo[0], hi[0])).tolist()) == want
    assert len(fm.search(np.array([[1, 2, 1, 3, 1, 2, 3, 3, 3, 3, 3, 3]]), np.array([12]))[0]) in (0, 1)


@pytest.mark.parametrize("block_words", [1 << 20, 3])
def test_leaks_match_brute_force(spark, block_words):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, spans string")
    got = decontam.find_leaks(rows.documents(spark), items, block_words=block_words).collect()
    flat = sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in got), key=str)
    assert flat == brute(rows.DOCUMENTS, ITEMS)
    assert all(a["end"] < b["start"] for r in got for a, b in zip(r["spans"], r["spans"][1:]))


def test_small_shards_give_the_same(spark, monkeypatch):
    phrases = decontam.Phrases([(str(i), t) for i, t in ITEMS if i is not None], 10)
    shard, seen = decontam.Shard(phrases), 0
    import pyarrow as pa

    for _, text in rows.DOCUMENTS:
        words, at = decontam.WordHasher(decontam.SEPARATORS)(pa.array([text], pa.string()))
        if len(words):
            shard.add(words, at, seen)
        seen += 1
    hit, *_ = shard.hits()
    assert {rows.DOCUMENTS[r][0] for r in hit} == {d for d, _, n, _ in brute(rows.DOCUMENTS, ITEMS) if n}


def test_spans_are_cut_and_clean_documents_stay(spark):
    items = spark.createDataFrame([(1, rows.PASSAGE)], "item_id bigint, text string")
    docs = rows.documents(spark)
    out = decontam.without_leaks(docs, items)
    assert out.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    whole = {r for r in rows.DOCUMENTS if r[0] not in (10, 11)}
    assert whole <= texts and 11 not in {i for i, _ in texts}
    cut = next(t for i, t in texts if i == 10)
    assert rows.PASSAGE.split()[3] + " " + rows.PASSAGE.split()[4] not in cut.lower() and cut.startswith(rows.sentence(5, 30))


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_words"] for r in decontam.find_leaks(rows.documents(spark, [(1, "a b"), (2, None)]), none).collect()} == {2, 0}
    assert decontam.find_leaks(rows.documents(spark, []), none).count() == 0
