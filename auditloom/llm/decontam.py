"""Benchmark decontamination with one FM-index per shard of the training text.

A task gathers the words of its documents until a shard is full, indexes the shard, searches
every test phrase backwards in it, locates the occurrences, and merges them to spans. Words
outside the vocabulary of the phrases can't be part of an occurrence: they become separators,
and stretches shorter than the shortest phrase are left out of the index. That loses nothing
and makes a shard of many documents small.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from auditloom.llm.common import apart
from auditloom.llm.fmindex import FMIndex
from auditloom.llm.words import WordHasher, slices

#: Bytes that end a word, after lower-casing: ASCII other than letters and digits.
SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WINDOW = 10
SHARD_WORDS = 1 << 19
SHARD_DOCUMENTS = 1 << 16
#: Texts that a pass holds until the shard is searched, if it hands them on.
SHARD_BYTES = 8 << 20
#: Words of test items that one pass over the documents carries to the tasks; more items make more passes.
BLOCK_WORDS = 1 << 20


class Phrases:
    """Windows of a block of test items, as symbols of the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.ids = [i for i, _ in items]
        words, at = WordHasher(SEPARATORS)(pa.array([t for _, t in items], pa.string()))
        self.vocabulary = np.unique(words)
        symbols = np.searchsorted(self.vocabulary, words) + 1
        owners: dict[tuple, set[int]] = {}
        for k in range(len(items)):
            own = symbols[at[k]: at[k + 1]].tolist()
            for i in range(max(1, len(own) - window + 1) if own else 0):
                owners.setdefault(tuple(own[i: i + window]), set()).add(k)
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.patterns = np.zeros((len(owners), window), np.int64)
        for row, p in zip(self.patterns, owners):
            row[window - len(p):] = p
        self.owners = np.array([k for own in owners.values() for k in sorted(own)], np.int64)
        self.owner_at = np.concatenate(([0], np.cumsum([len(own) for own in owners.values()]))).astype(np.int64)
        self.least = int(self.lengths.min()) if len(owners) else 0

    def symbols(self, words: np.ndarray) -> np.ndarray:
        spot = np.searchsorted(self.vocabulary, words)
        spot[spot == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[spot] == words, spot + 1, 0)


class Shard:
    """Words of some documents that can be part of a phrase."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.parts, self.size = phrases, [], 0

    def add(self, words: np.ndarray, at: np.ndarray, first_row: int) -> None:
        symbols = self.phrases.symbols(words)
        rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
        cut = np.flatnonzero((symbols[1:] == 0) | (symbols[:-1] == 0) | (rows[1:] != rows[:-1])) + 1
        starts = np.concatenate(([0], cut)).astype(np.int64)
        ends = np.concatenate((cut, [len(symbols)])).astype(np.int64)
        long = (symbols[starts] > 0) & (ends - starts >= self.phrases.least)
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return
        # One separator after each stretch.
        sizes = ends - starts + 1
        offset = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(sizes.sum()) - np.repeat(offset, sizes) + np.repeat(starts, sizes)
        last = offset + sizes - 1
        place[last] = ends - 1
        text = symbols[place]
        text[last] = 0
        self.parts.append((text, first_row + rows[place], place - at[rows[place]]))
        self.size += len(text)

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows and first and end words of the merged spans; rows and items that occur."""
        none = np.zeros(0, np.int64)
        if not self.parts:
            return none, none, none, none, none
        text, rows, index = (np.concatenate(x) for x in zip(*self.parts))
        fm = FMIndex(text, len(self.phrases.vocabulary))
        which, lo, hi = fm.search(self.phrases.patterns, self.phrases.lengths)
        many = hi - lo
        pattern = np.repeat(which, many)
        place = fm.locate(np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many))
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + self.phrases.lengths[pattern], -1)
        hit = np.cumsum(cover[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).view(np.int8)))
        begin, end = edge[0::2], edge[1::2]
        own = np.diff(self.phrases.owner_at)[pattern]
        item = self.phrases.owners[np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
                                   + np.repeat(self.phrases.owner_at[pattern], own)]
        pairs = np.unique(np.stack((np.repeat(rows[place], own), item)), axis=1)
        return rows[begin], index[begin], index[end - 1] + 1, pairs[0], pairs[1]


def _merged(spans: list[dict]) -> list[dict]:
    """Spans in order, those that meet joined."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["start"]):
        if out and s["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], s["end"])}
        else:
            out.append(s)
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _scan(phrases: Phrases, keep: list[str], cut: bool = False):
    """One pass: adds to ``_spans`` and ``_items`` what the phrases hit, and sets ``_n_words``. With
    ``cut`` the spans go from ``text``, which must be kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, shard, held, rows, size = WordHasher(SEPARATORS), Shard(phrases), [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal shard, held, rows, size
            row, start, end, item_row, item = (x.tolist() for x in shard.hits())
            spans: dict[int, list] = {}
            items: dict[int, list] = {}
            for r, s, e in zip(row, start, end):
                spans.setdefault(r, []).append({"start": s, "end": e})
            for r, k in zip(item_row, item):
                items.setdefault(r, []).append(phrases.ids[k])
            done = 0
            for batch, counts in held:
                old_spans, old_items = batch["_spans"].to_pylist(), batch["_items"].to_pylist()
                for i in range(len(batch)):
                    if done + i in items:
                        old_spans[i] = _merged(old_spans[i] + spans[done + i])
                        old_items[i] = sorted({*old_items[i], *items[done + i]})
                columns = {c: batch[c] for c in keep}
                if cut and any(old_spans):
                    columns["text"] = pa.array([_without(t, s) if s else t for t, s in zip(batch["text"].to_pylist(), old_spans)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns.values(), pa.array(counts, pa.int64()), pa.array(old_spans, pa.list_(_SPAN)),
                     pa.array(old_items, pa.list_(pa.string()))], names=[*keep, "_n_words", "_spans", "_items"])
                done += len(batch)
            shard, held, rows, size = Shard(phrases), [], 0, 0

        for batch in batches:
            for part in slices(batch, "text"):
                words, at = hasher(part["text"])
                if len(words) and phrases.least:
                    shard.add(words, at, rows)
                held.append((part.select([*keep, "_spans", "_items"]), np.diff(at)))
                rows += len(part)
                size += part.nbytes if "text" in keep else 0
                if shard.size >= SHARD_WORDS or rows >= SHARD_DOCUMENTS or size >= SHARD_BYTES:
                    yield from flush()
        yield from flush()

    return run


def item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """Test items in runs of at most ``block_words`` words (one item at least), read one
    partition at a time, so the driver holds one block."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("string"), "text").where("item_id IS NOT NULL").toLocalIterator():
        words = len(row["text"] or "") // 2 + 1
        if block and size + words > block_words:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += words
    if block:
        yield block


def _searched(documents: DataFrame, items: DataFrame, keep: list[str], window: int, block_words: int, cut: bool = False) -> DataFrame:
    """Columns ``keep`` of ``documents`` with ``_n_words``, ``_spans`` and ``_items``."""
    more = ", _n_words bigint, _spans array<struct<start:bigint,end:bigint>>, _items array<string>"
    kinds = dict(documents.dtypes)
    rows = documents.select(*[f"`{c}`" for c in {*keep, "text"}], F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)").alias("_spans"),
                            F.expr("CAST(array() AS array<string>)").alias("_items"))
    blocks = item_blocks(items, block_words)
    block = next(blocks, [])
    while True:
        following = next(blocks, None)
        columns = list(dict.fromkeys([*keep, "text"])) if following else keep
        rows = rows.mapInArrow(_scan(Phrases(block, window), columns, cut and not following), ", ".join(f"`{c}` {kinds[c]}" for c in columns) + more)
        if not following:
            return rows
        block = following


def find_leaks(documents: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Occurrences of test items in documents.

    ``documents`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and ``text``; other
    columns are ignored. A window is ``window`` consecutive words of an item, or the whole item
    if it has fewer words but not none. Returns one row per document row: ``doc_id``,
    ``n_words``, ``spans`` (merged, in words, end exclusive) and ``items`` (sorted as strings).

    Null and empty texts have no words. An item without words, or with a null id, has no window.
    Equal item ids count as one item. Repeated document rows stay repeated. The items are the
    query set: they go to the tasks in blocks of ``block_words``; each further block is
    one more pass in the same tasks, without a shuffle.
    """
    return _searched(documents, items, ["doc_id"], window, block_words).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def _without(text: str, spans: list[dict]) -> str:
    words = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for s in spans:
        out.append(text[at: words[s["start"]][0]])
        at = words[s["end"] - 1][1]
    return "\n".join([*out, text[at:]])


def without_leaks(documents: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents``, all columns kept, with the spans that ``find_leaks`` gives cut from ``text``; what
    stood around a span is joined by a line feed. A document of which no word is left goes;
    documents without a span stay as they are."""
    rows = apart(documents)
    found = _searched(rows, items, rows.columns, window, block_words, cut=True)
    left = F.col("_n_words") > F.aggregate("_spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return found.where(left | (F.size("_spans") == 0)).select(*[f"`{c}`" for c in rows.columns]).toDF(*documents.columns)
