from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import rows
from auditloom.llm import divergence


def brute(data, least_df=3, top=200):
    """``data``: (lang, source, text). Rows of ``divergence`` by its definition."""
    data = [tuple(x or "" for x in r) for r in data]
    words = [[w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for _, _, t in data]
    out = []
    for lang in {r[0] for r in data}:
        df = Counter(w for r, ws in zip(data, words) if r[0] == lang for w in set(ws))
        kept = {w for w, n in df.items() if n >= least_df}
        counts = defaultdict(Counter)
        for r, ws in zip(data, words):
            if r[0] == lang:
                counts[r[1]].update(w for w in ws if w in kept)
        whole = sum(counts.values(), Counter())
        v = len(kept)
        p = {s: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + v) for w in kept} for s, c in counts.items()}
        q = {w: 1 + 10**9 * (whole[w] + 1) // (sum(whole.values()) + v) for w in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in counts if o != s]
            terms = [(f(p[s][w], q[w]), w) for w in kept if counts[s][w] > 0 and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, w, x, k + 1) for k, (x, w) in enumerate(sorted(found, key=lambda r: (-r[0], r[1].encode()))[:most])]
    return sorted(out)


def frame(spark, data):
    return spark.createDataFrame([(i, t, la, s, "x", "y", 1) for i, (la, s, t) in enumerate(data)],
                                 "doc_id bigint, text string, lang string, source string, term string, p string, n int").repartition(3)


def sample(seed, n, sources=6):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(150)] + ["Éa", "日本", "MiXed", "mixed", "prefixword", "prefixwords", "prefixwordsandmore", "ab" * 400]
    return [(["en", "de", None][rng.integers(3)], [None, *(f"s{k}" for k in range(sources))][rng.integers(sources + 1)],
             " ".join(rng.choice(words, rng.integers(0, 60) ** 2 // 30)) + rng.choice(["", "!", "1st", "\x00"])) for _ in range(n)]


@pytest.mark.parametrize("chunk, block", [(256, 2048), (3, 16)])
def test_matches_brute_force(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(divergence, "CHUNK_SOURCES", chunk)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    data = sample(1, 300) + [("fr", "only", "a b c"), ("it", "x", None), ("it", "y", ""), ("it", "z", "1 2 3"), ("en", "silent", "?"), ("en", "s1", "lone")]
    data += [("en", "s2", "copy of one text that many rows repeat")] * 200
    got = sorted(map(tuple, divergence.divergence(frame(spark, data), top=20).collect()))
    assert got == brute(data, top=20)


def test_empty_table_and_awkward_rows(spark):
    assert divergence.divergence(frame(spark, []).where("false")).count() == 0
    data = [("en", "src0", t) for _, t in rows.DOCUMENTS]
    assert sorted(map(tuple, divergence.divergence(rows.documents(spark)).collect())) == brute(data)


def test_pointers_are_in_word_order(monkeypatch):
    monkeypatch.setattr(divergence, "LARGE", 8)
    texts = ["".join(t) for t in (["b a b Zz"], ["x" * 1000, " ", "x" * 999, " ", "x" * 1001, " ", "x" * 1000], [], ["aé ae aé b"], [" 12 "], ["aaaaaaaa aaaaaaaab aaaaaaaa aaaaaaa"])] + ["b c d e f g h i j k a b"] * 9
    found = divergence.Pointers(pa.array(texts + [None]))
    want = sorted(w.lower().encode() for t in texts for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t))
    got = [bytes(found.raw[s: s + n]) for s, n in zip(found.starts, found.lengths)]
    assert got == want
    assert [w.encode() for w in found.words().to_pylist()] == sorted(set(want))
    assert found.run.tolist() == [sorted(set(want)).index(w) for w in want]


def test_probability_of_very_large_counts(spark):
    big = 9 * 10**17
    row = spark.createDataFrame([(big, 7 * big, 12345)], "c bigint, n bigint, v bigint").select(divergence.probability("c", "n", "v").alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 1) // (7 * big + 12345)
