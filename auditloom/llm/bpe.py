"""Byte-level BPE by corpus-level merge replay.

A task splits the texts of its partition into words, keeps every distinct word once, and
replays the merges over all of them together: an inverted index from token pair (named by the
token it makes) to positions; merges in rank order; a merge touches only the neighbours of
its positions. Texts are then rows of word numbers, and their ids a gather.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from auditloom.llm.words import slices, utf8

#: Bytes of text that one replay covers; and bytes of words that a worker remembers between replays.
CORPUS_BYTES = 8 << 20
MEMORY_BYTES = 4 << 20
_NONE = np.int32(np.iinfo(np.int32).max)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens of a rank file: lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeTable:
    """Ranks of a vocabulary. A pair of tokens merges to the token of their joined bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.token_size = np.array([len(t) for t in self.token], np.int64)
        self.token_at = np.concatenate(([0], np.cumsum(self.token_size)[:-1]))
        self.token_bytes = np.frombuffer(b"".join(self.token), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        spot = np.searchsorted(self.keys, key)
        spot[spot == len(self.keys)] = 0
        return np.where(self.keys[spot] == key, self.made[spot], _NONE)

    def one(self, word: bytes) -> list[int]:
        """Merges of one word by lowest rank, then leftmost."""
        parts = [word[i: i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, _NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == _NONE:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and for each word the number of ids before it."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        n = len(flat)
        ends = np.cumsum(sizes)
        token = self.byte[flat]
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        live = np.ones(n, bool)
        made = np.full(n, _NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        made[inner] = self.rank(token[inner], token[inner + 1])

        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enlist(at: np.ndarray) -> None:
            at = at[made[at] != _NONE]
            if not len(at):
                return
            kind = made[at]
            order = np.argsort(kind, kind="stable")
            at, kind = at[order], kind[order]
            cut = np.flatnonzero(kind[1:] != kind[:-1]) + 1
            for r, part in zip(kind[np.concatenate(([0], cut))].tolist(), np.split(at, cut)):
                if r in waiting:
                    waiting[r].append(part)
                else:
                    waiting[r] = [part]
                    heapq.heappush(queue, r)

        enlist(inner)
        odd: list[np.ndarray] = []
        while queue:
            r = heapq.heappop(queue)
            parts = waiting.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))  # a part is in order
            at = at[made[at] == r]
            if not len(at):
                continue
            right = after[at]
            # Of pairs that share a token, as in "aaa", every second one from the left merges.
            chained = np.concatenate(([False], right[:-1] == at[1:]))
            if chained.any():
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                keep = run % 2 == 0
                at, right = at[keep], right[keep]
            beyond = after[right]
            token[at] = r
            live[right] = False
            made[right] = _NONE
            after[at] = beyond
            there = beyond >= 0
            before[beyond[there]] = at[there]
            made[at[~there]] = _NONE
            left = before[at]
            touched = np.unique(np.concatenate((at[there], left[left >= 0])))
            if len(touched):
                new = self.rank(token[touched], token[after[touched]])
                made[touched] = new
                if new.min() < r:
                    odd.append(touched[new < r])
                enlist(touched)
        ids = token[live]
        bounds = np.concatenate(([0], np.cumsum(live)))[np.concatenate(([0], ends))]
        again = {int(k) for k in np.searchsorted(ends, np.concatenate(odd), side="right")} if odd else set()
        again |= {k for k, w in enumerate(words) if w in self.ranks and bounds[k + 1] - bounds[k] != 1}
        if again:
            # A merge that makes a pair of lower rank, or a word that is a token but no merge reaches it.
            rows = np.split(ids, bounds[1:-1])
            for k in again:
                whole = self.ranks.get(words[k])
                rows[k] = np.array(self.one(words[k]) if whole is None else [whole], np.int32)
            ids = np.concatenate(rows)
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
        return ids, bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of rows of ids, and the rows' bounds in bytes."""
        size = self.token_size[ids]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.token_at[ids] - (ends - size), size)
        return self.token_bytes[place], np.concatenate(([0], ends))[bounds]


class Encoder:
    """Distinct words seen by a worker, and their ids."""

    def __init__(self, table: MergeTable, pattern: str):
        self.table, self.split = table, regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.size = 0

    def rows(self, texts: list[str | None]) -> list[np.ndarray]:
        """Word numbers of each text."""
        number, out = self.number, []
        for text in texts:
            words = self.split(text) if text else []
            try:
                out.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            except KeyError:
                for w in words:
                    if w not in number:
                        number[w] = len(number)
                out.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        return out

    def learn(self) -> None:
        """Replays the merges over the words that have no ids yet."""
        fresh = [w.encode() for w in list(self.number)[len(self.bounds) - 1:]]
        if fresh:
            ids, bounds = self.table.replay(fresh)
            self.bounds = np.concatenate((self.bounds, bounds[1:] + len(self.ids)))
            self.ids = np.concatenate((self.ids, ids))
            self.size += sum(map(len, fresh))

    def encode(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of word numbers, and the rows' bounds."""
        words = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        start, size = self.bounds[words], self.bounds[words + 1] - self.bounds[words]
        ends = np.cumsum(size)
        ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]
        at = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)]
        return ids, at


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(MergeTable(read_ranks(path)), pattern)


def _work(path: str, pattern: str, decode: bool):
    names = ["doc_id", "ids", "decoded"][: 2 + decode]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        held: list[tuple[pa.Array, list[np.ndarray]]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            encoder.learn()
            for ids_of, rows in held:
                ids, at = encoder.encode(rows)
                out = [ids_of, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))]
                if decode:
                    raw, ends = encoder.table.decode(ids, at)
                    out.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)]))
                yield pa.RecordBatch.from_arrays(out, names=names)
            held.clear()
            pa.default_memory_pool().release_unused()
            if encoder.size > MEMORY_BYTES:
                encoder.forget()

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                held.append((part["doc_id"], encoder.rows(part["text"].to_pylist())))
                size += int(utf8(part["text"])[1][-1])
                if size >= CORPUS_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def encode(documents: DataFrame, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """Token ids of whole texts by the ranks in the file ``path``; each match of ``pattern`` is
    encoded by itself, without special tokens.

    ``documents`` needs ``doc_id`` and ``text``; other columns are ignored. Returns ``doc_id``
    and ``ids``, with ``decode`` also ``decoded``, the bytes of the ids; one row per
    input row, repeated ones too. A null text counts as empty: no ids and no bytes. The file is
    opened by the tasks, so it must be installed on every machine.
    """
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(
        _work(path, pattern, decode), f"doc_id {kind}, ids array<int>" + ", decoded binary" * decode)
