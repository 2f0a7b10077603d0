"""Source divergence audit: terms counted by sorting pointers to word starts.

1. A task takes its texts in slices, ordered by (lang, source). The bytes of a slice stay where
   Arrow has them; a word is a pointer to its start. Pointers are ordered by multikey
   quicksort, eight bytes at a time: a run is split three ways around a pivot while it is
   large, sorted by its next eight bytes once it is small, and only runs that still agree go
   on to the bytes after them.
2. Equal runs are the terms of the slice. Where the group or the document changes inside a run
   gives the term's count and its number of documents in each source.
3. Slices are summed in Spark. What a group's counts say against another source's, or against
   its language as a whole, is compared with exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from auditloom.llm.common import stored
from auditloom.llm.words import slices, utf8

#: Pointers of a run from which it is split around a pivot rather than sorted at once.
LARGE = 1 << 15
#: Terms of a block and sources of a chunk: what one comparing task holds at a time.
BLOCK_TERMS = 2048
CHUNK_SOURCES = 256
#: Rows that a counting task holds.
HELD = 1 << 20

SCALE = 1_000_000_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
_MASKS = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], np.uint64)


class Pointers:
    """Word starts of a slice of texts, in the order of their words.

    ``starts``, ``lengths`` and ``text`` (row of the slice) follow the order of words; ``run``
    numbers the equal words.
    """

    def __init__(self, texts: pa.Array):
        raw, bounds = utf8(texts)
        self.raw = np.zeros(len(raw) + 8, np.uint8)
        self.raw[: len(raw)] = _LOWER[raw]
        inside = _LETTER[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        cuts = bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        begins[cuts] |= inside[cuts]
        finish[cuts - 1] |= inside[cuts - 1]
        self.windows = np.lib.stride_tricks.sliding_window_view(self.raw, 8)
        self.starts = np.flatnonzero(begins)
        self.lengths = np.flatnonzero(finish) + 1 - self.starts
        order, new = self._sorted()
        self.starts, self.lengths = self.starts[order], self.lengths[order]
        self.text = np.searchsorted(bounds, self.starts, side="right") - 1
        self.run = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)

    def _keys(self, mine: np.ndarray, depth: int) -> np.ndarray:
        """The eight bytes of words ``mine`` from ``depth`` on, as numbers that order like the bytes; beyond a
        word's end they are zero, which no word holds."""
        at = np.minimum(self.starts[mine] + depth, len(self.raw) - 8)
        left = np.minimum(self.lengths[mine] - depth, 8)
        return self.windows[at].view(">u8").ravel().astype(np.uint64) & _MASKS[left]

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions in word order, and where a word differs from the one before.

        A run (from, to, depth) holds words that agree in their first ``depth`` bytes, and go on. Small
        runs of one depth are sorted together.
        """
        order = np.arange(len(self.starts))
        new = np.zeros(len(order), bool)
        new[:1] = True
        large, small = ([(0, len(order), 0)] if len(order) else []), {}

        def put(lo: int, hi: int, depth: int) -> None:
            if hi - lo > LARGE:
                large.append((lo, hi, depth))
            elif hi - lo > 1:
                small.setdefault(depth, []).append((np.array([lo]), np.array([hi])))

        while large:
            lo, hi, depth = large.pop()
            mine = order[lo:hi]
            keys = self._keys(mine, depth)
            sample = np.sort(keys[:: len(keys) // 255 + 1])
            pivot = sample[len(sample) // 2]
            below, same = keys < pivot, keys == pivot
            parts = [mine[below], mine[same], mine[~(below | same)]]
            order[lo:hi] = np.concatenate(parts)
            a, b = lo + len(parts[0]), hi - len(parts[2])
            new[a] = True
            new[b: b + (b < hi)] = True
            put(lo, a, depth)
            put(b, hi, depth)
            if pivot & np.uint64(0xFF):
                put(a, b, depth + 8)
        while small:
            depth = min(small)
            froms, tos = (np.concatenate(c) for c in zip(*small.pop(depth)))
            sizes = tos - froms
            run = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(run)) + np.repeat(froms - (np.cumsum(sizes) - sizes), sizes)
            mine = order[place]
            keys = self._keys(mine, depth)
            by = np.lexsort((keys, run))
            order[place] = mine[by]
            keys = keys[by]
            change = np.ones(len(keys), bool)
            change[1:] = (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])
            new[place[change]] = True
            edges = np.append(np.flatnonzero(change), len(keys))
            # A word's last key ends in a zero byte.
            more = (np.diff(edges) > 1) & ((keys[edges[:-1]] & np.uint64(0xFF)) != 0)
            if more.any():
                start = place[edges[:-1][more]]
                small.setdefault(depth + 8, []).append((start, start + np.diff(edges)[more]))
        return order, new

    def words(self) -> pa.Array:
        """The word of each run."""
        starts, lengths = self.starts[self.first], self.lengths[self.first]
        ends = np.cumsum(lengths)
        at = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.concatenate(([0], ends)).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(self.raw[at])).cast(pa.string())


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_count`` with the slices of a task summed, at most about ``HELD`` of them at a time."""
    names, held, count = ["lang", "source", "term", "count", "df"], [], 0
    for batch in _count(batches):
        held.append(batch)
        count += len(batch)
        if count > HELD:
            total = pa.Table.from_batches(held).group_by(names[:3]).aggregate([("count", "sum"), ("df", "sum")]).rename_columns(names)
            if len(total) > HELD // 2:
                yield from total.to_batches()
                held, count = [], 0
            else:
                held, count = total.to_batches(), len(total)
    yield from held


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice, group and term: occurrences and documents; a group's row without a term stands for
    the group itself."""
    names = ["lang", "source", "term", "count", "df"]
    for batch in batches:
        for part in slices(batch, "text"):
            sides = [part[c].dictionary_encode() for c in ("lang", "source")]
            codes = [np.asarray(s.indices).astype(np.int64) for s in sides]
            group = codes[0] * max(1, len(sides[1].dictionary)) + codes[1]
            order = np.argsort(group, kind="stable")
            found = Pointers(part["text"].take(pa.array(order)))
            group = group[order]
            # Inside a run by text, and so by group, for texts are in the order of groups.
            at = np.sort(found.run * len(part) + found.text)
            run, text = at // len(part), at % len(part)
            change = np.ones(len(at), bool)
            change[1:] = (run[1:] != run[:-1]) | (group[text[1:]] != group[text[:-1]])
            first = np.flatnonzero(change)
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1]
            count = np.diff(np.append(first, len(at)))
            df = np.add.reduceat(fresh.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
            alone = np.unique(group)
            who = np.concatenate((group[text[first]], alone))
            size = max(1, len(sides[1].dictionary))
            terms = found.words().take(pa.array(run[first]))
            none = pa.nulls(len(alone), pa.string())
            zero = np.zeros(len(alone), np.int64)
            yield pa.RecordBatch.from_arrays(
                [sides[0].dictionary.take(pa.array(who // size)), sides[1].dictionary.take(pa.array(who % size)),
                 pa.concat_arrays([terms, none]), pa.array(np.concatenate((count, zero))), pa.array(np.concatenate((df, zero)))], names=names)


def term_counts(documents: DataFrame) -> DataFrame:
    """``count`` occurrences and ``df`` documents of each term in each (lang, source): ``lang``, ``source``, ``term``,
    ``count``, ``df``. Every (lang, source) also has a row with a null term and zeros.

    Null ``lang``, ``source`` and ``text`` read as ''. A term is a run of letters A-Z, a-z and of characters
    beyond ASCII, with A-Z lower-cased. Repeated rows count again; columns besides these three
    are ignored.
    """
    texts = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = texts.mapInArrow(_summed, "lang string, source string, term string, count bigint, df bigint")
    return counts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("df").alias("df"))


def probability(count: str | Column, total: str | Column, terms: str | Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + terms)), exactly, for counts of any size."""
    wide = [(c if isinstance(c, Column) else F.col(c)).cast("decimal(19,0)") for c in (count, total, terms)]
    top = (wide[0] + F.lit(1).cast("decimal(1,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, wide[1] + wide[2]) + 1


def excess(p: str, q: str) -> Column:
    """floor((p - q)^2 / q): both lie between 1 and 10^9 + 1, so the square fits in 64 bits."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) DIV ({q})")


def _compare(group: pa.Table) -> pa.Table:
    """Sums over a block of terms of what each source of one chunk says against each of another.

    Rows without a term give the sources of both chunks with the probability of a term that
    they don't hold.
    """
    source, side = group["source"].to_pylist(), group["side"].to_numpy()
    p, term = group["p"].to_numpy(), group["term"].combine_chunks().dictionary_encode()
    at = np.asarray(term.indices.fill_null(-1)).astype(np.int64)
    tables = {}
    for s in (0, 1):
        rows = np.flatnonzero(side == s)
        names = {}
        for r in rows[at[rows] < 0]:
            names.setdefault(source[r], (len(names), p[r]))
        table = np.repeat(np.array([x for _, x in names.values()], np.int64)[:, None], len(term.dictionary), axis=1)
        rows = rows[at[rows] >= 0]
        table[[names[source[r]][0] for r in rows], at[rows]] = p[rows]
        tables[s] = (list(names), table)
    ways = [(0, 0)] if group["lo"][0] == group["hi"][0] else [(0, 1), (1, 0)]
    one, other, value = [], [], []
    for (mine, x), (theirs, y) in [(tables[i], tables[j]) for i, j in ways]:
        for name, row in zip(mine, x):
            found = ((row - y) ** 2 // y).sum(axis=1)
            for k, (friend, v) in enumerate(zip(theirs, found.tolist())):
                if friend != name:
                    one.append(name)
                    other.append(friend)
                    value.append(v)
    n = len(one)
    return pa.table({"lang": pa.array(group["lang"].to_pylist()[:1] * n, pa.string()), "source": pa.array(one, pa.string()),
                     "item": pa.array(other, pa.string()), "value": pa.array(value, pa.int64()),
                     "seen": pa.array([len(term.dictionary)] * n, pa.int64())})


def divergence(documents: DataFrame, least_df: int = 3, top: int = 200) -> DataFrame:
    """How the sources of each language differ in their words.

    Each ``lang`` keeps the V terms in at least ``least_df`` of its documents. A group is one (lang, source),
    and each language is one as well; with N occurrences of kept terms, ``p`` of a term is
    1 + floor(10^9 * (count + 1) / (N + V)). What p says against q is floor((p - q)^2 / q).
    Returns ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``:

    * ``pair``: for each other source of the language, the sum over all kept terms (0 without any).
    * ``term``: the ``top`` kept terms of the group that it has more of than its language.

    ``rank`` runs from 1 by falling value, then by item in the order of UTF-8. Columns read and how
    nulls count: ``term_counts``. An empty table gives no rows; a language of one source has no
    ``pair`` rows; sources without a kept term are compared like others.
    """
    counts = stored(term_counts(documents), "divergence-counts")
    kept = (counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("count").alias("whole"))
            .where(F.col("df") >= least_df).drop("df"))
    kept = stored(kept, "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("whole").alias("lang_n"))
    held = stored(counts.where("term IS NOT NULL").drop("df").join(kept, ["lang", "term"]), "divergence-held")
    sums = held.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = (counts.where("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["n", "v", "lang_n"]))
    # A source's place among those of its language deals it to a chunk.
    placed = groups.withColumn("sources", F.expr("count(*) OVER (PARTITION BY lang)")).withColumn(
        "chunks", F.ceil(F.col("sources") / CHUNK_SOURCES).cast("int"))
    groups = stored(placed.withColumn("chunk", F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int"))
                    .withColumn("blocks", F.ceil(F.col("v") / BLOCK_TERMS).cast("int"))
                    .withColumn("p0", F.when(F.col("v") > 0, probability(F.lit(0), "n", "v"))), "divergence-groups")

    rows = held.join(groups.select("lang", "source", "n", "v", "lang_n", "chunk", "chunks", "blocks"), ["lang", "source"])
    rows = rows.withColumn("p", probability("count", "n", "v"))
    empty = groups.where("v > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = (rows.select("lang", "source", "term", "p", "chunk", "chunks", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"))
             .unionByName(empty.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "chunk", "chunks", "block"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("lang", "block", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                     (F.col("chunk") > F.col("other")).cast("int").alias("side"), "source", "term", "p"))
    parts = (cells.groupBy("lang", "block", "lo", "hi")
             .applyInArrow(_compare, "lang string, source string, item string, value bigint, seen bigint")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")))
    mine = groups.select("lang", "source", "p0", "v")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    # Terms that neither of the two holds weigh alike.
    pairs = (mine.join(theirs, "lang").where("source != item").join(parts, ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.when(F.col("v") == 0, 0).otherwise(F.coalesce("value", F.lit(0)) + (F.col("v") - F.coalesce("seen", F.lit(0))) * excess("p0", "q0"))
                     .cast("bigint").alias("value")))
    rank = F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)").cast("int")
    pairs = pairs.withColumn("rank", rank)
    terms = (rows.withColumn("q", probability("whole", "lang_n", "v")).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess("p", "q").alias("value"))
             .withColumn("rank", rank).where(F.col("rank") <= top))
    return pairs.unionByName(terms)
