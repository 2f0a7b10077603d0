from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken

import rows
from auditloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_replay_matches_one_word_at_a_time(reference):
    rng = random.Random(1)
    parts = ["a", "aa", "in", "ing", "er", "th", "é", "日本", "ß", "\U0001f600", "1", "  ", "\n", "'s", "́", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    encoder = bpe.Encoder(bpe.MergeTable(bpe.read_ranks(PATH)), public_tokenizers.PATTERN)
    for half in (texts[:1500], texts[1500:]):
        numbered = encoder.rows(half)
        encoder.learn()
        ids, at = encoder.encode(numbered)
        raw, ends = encoder.table.decode(ids, at)
        for k, text in enumerate(half):
            assert ids[at[k]: at[k + 1]].tolist() == reference.encode_ordinary(text)
            assert raw[ends[k]: ends[k + 1]].tobytes() == text.encode()


def test_rows(spark, reference, monkeypatch):
    got = bpe.encode(rows.documents(spark), PATH, public_tokenizers.PATTERN, decode=True).collect()
    want = sorted((str(i), reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows.DOCUMENTS)
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in got) == want
    assert bpe.encode(rows.documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_small_memory_gives_the_same(reference, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "CORPUS_BYTES", 2000)
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 500)
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows.DOCUMENTS], "text": [t for _, t in rows.DOCUMENTS]})
    out = [r for b in bpe._work(PATH, public_tokenizers.PATTERN, False)(iter([batch.slice(k, 1) for k in range(len(batch))])) for r in b.to_pylist()]
    assert [r["ids"] for r in out] == [reference.encode_ordinary(t or "") for _, t in rows.DOCUMENTS]
