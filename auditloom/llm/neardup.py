"""MinHash near-duplicates with sequential Bayesian verification (after BayesLSH, 2012).

1. Texts with equal shingle sets are one class; everything after works on classes.
2. A class has ``HASHES`` MinHash values; the first ones form bands. Classes that agree on a
   band are candidates.
3. Round one compares every class with the smallest class of each of its buckets, and joins
   what it confirms. Round two compares the rest: within a bucket, all pairs of classes that
   are not in one component yet, in blocks of bounded size, inside the task. So a group of
   copies of any size costs about one comparison a member, and no pair is dropped.
4. A comparison reads signatures batch by batch and stops as soon as the posterior
   probability of reaching the similarity falls under ``MISS``. Survivors are confirmed on the
   full sets, which are made anew from the texts; only texts of survivors are moved.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from auditloom.llm.common import apart, durable, stored
from auditloom.llm.components import components
from auditloom.llm.words import WordHasher, mix, slices

SPACES = b" \t\n\x0b\x0c\r"
HASHES = 256
BAND_ROWS = 4
BANDS = 32
BATCH = 32
MISS = 1e-6
BLOCK = 1024
PAIRS_PER_GROUP = 4096

_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)


def shingle_sets(texts: pa.Array, width: int, hasher: WordHasher) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of each text; with fewer words the
    whole sequence is the one shingle; without words the set is empty."""
    words, at = hasher(texts)
    out = []
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled + words[k: k + len(rolled)] * np.uint64(2 * k + 1))
    for lo, hi in zip(at[:-1], at[1:]):
        if hi - lo >= width:
            out.append(np.unique(rolled[lo: hi - width + 1]))
        else:
            h = np.zeros(int(hi > lo), np.uint64)
            for k in range(hi - lo):
                h = mix(h + words[lo + k: lo + k + 1] * np.uint64(2 * k + 1) + np.uint64(1))
            out.append(h)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 512):
        h = x[i: i + 512, None] * _MULTIPLY + _ADD
        np.minimum(low, (h ^ (h >> np.uint32(15))).min(axis=0), out=low)
    return low


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _describe(width: int):
    """Per row: size of the set, class, bucket keys, and 16 bits of each MinHash value."""
    names = ["doc_id", "text_hash", "n_shingles", "node", "buckets", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, salt = WordHasher(SPACES), mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, nodes, keys, sigs = [], [], [], []
                known: dict[bytes, tuple] = {}
                for s in shingle_sets(part["text"], width, hasher):
                    node = _digest(s)
                    if node not in known:
                        sig = signature(s)
                        bands = sig[: BANDS * BAND_ROWS].astype(np.uint64).reshape(BANDS, BAND_ROWS)
                        key = salt.copy()
                        for k in range(BAND_ROWS):
                            key = mix(key + bands[:, k])
                        known[node] = (key.view(np.int64) if len(s) else None, sig.astype(np.uint16).tobytes())
                    sizes.append(len(s))
                    nodes.append(node)
                    keys.append(known[node][0])
                    sigs.append(known[node][1])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["text_hash"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], names=names)

    return run


def least_matches(threshold: float, miss: float) -> list[int]:
    """For each number of compared values (a multiple of ``BATCH``), the least number of matches
    at which the similarity still reaches ``threshold`` with a posterior probability of ``miss``.

    With a uniform prior, P(J >= t | m of n) is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return out


def _alive(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Indices of the rows whose signatures survive all batches."""
    at = np.arange(len(left))
    got = np.zeros(len(left), np.int32)
    for k, m in enumerate(least):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        got = got + (left[at, cols] == right[at, cols]).sum(axis=1, dtype=np.int32)
        keep = got >= m
        at, got = at[keep], got[keep]
        if not len(at):
            break
    return at


def _matrix(column: pa.Array, dtype=np.uint16) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, HASHES), dtype)
    bounds = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]: bounds[-1]]
    return raw.view(dtype).reshape(len(column), -1) if raw.flags.aligned else raw.copy().view(dtype).reshape(len(column), -1)


def _prune_pairs(least: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 4096):
                part = batch.slice(i, 4096)
                at = _alive(_matrix(part["sig_a"]), _matrix(part["sig_b"]), least)
                yield part.select(["home", "a", "b"]).take(pa.array(at))

    return run


class _Block:
    """Rows of one block pair of a bucket, and their cross pairs that survive the signatures.

    A pair that shares several buckets is taken in the first of them only; ``past`` has the keys
    of the buckets before this one.
    """

    def __init__(self, group: pa.Table, least: list[int]):
        self.sig, self.least = _matrix(group["sig"]), least
        self.comp = np.unique(np.array([c.hex() for c in group["comp"].to_pylist()]), return_inverse=True)[1]
        self.parent = list(range(len(group)))
        side = group["side"].to_numpy()
        self.one = group["lo"][0].as_py() == group["hi"][0].as_py()
        self.rows = np.flatnonzero(side == 0)
        self.others = self.rows if self.one else np.flatnonzero(side == 1)
        past = group["past"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.past = past.reshape(len(group), group["band"][0].as_py())

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = k = self.parent[self.parent[k]]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(self.comp[a]), self.root(self.comp[b])
        self.parent[a] = b
        return a != b

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        for k, i in enumerate(self.rows):
            js = self.others[k + 1:] if self.one else self.others
            js = js[self.comp[js] != self.comp[i]]
            if len(js):
                js = js[_alive(np.broadcast_to(self.sig[i], (len(js), HASHES)), self.sig[js], self.least)]
            if len(js):
                js = js[~(self.past[i] == self.past[js]).any(axis=1)]
            if len(js):
                yield int(i), js


_SUSPECT = ["bucket", "band", "lo", "hi", "side", "node", "comp"]


def _suspects(least: list[int]):
    """The rows of a block pair that have a pair to confirm there."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        found = np.zeros(len(group), bool)
        for i, js in _Block(group, least).pairs():
            found[i] = True
            found[js] = True
        return group.select(_SUSPECT).filter(pa.array(found))

    return run


def _confirm_block(width: int, percent: int, least: list[int]):
    """Links among the suspects of a block pair, on full sets, as many as join components."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(group: pa.Table) -> pa.Table:
        hasher, sets, nodes, keep, at = WordHasher(SPACES), [], group["node"].to_pylist(), {}, 0
        for batch in group.combine_chunks().to_batches():
            for part in slices(batch, "text"):
                for s in shingle_sets(part["text"], width, hasher):
                    if nodes[at] not in keep and _digest(s) == nodes[at]:
                        keep[nodes[at]] = at
                        sets.append(s)
                    at += 1
        rows = list(keep)
        group = group.take(pa.array(list(keep.values()))).combine_chunks()
        size = np.array([len(s) for s in sets])
        universe, flat = np.unique(np.concatenate(sets), return_inverse=True)
        bounds = np.concatenate(([0], np.cumsum(size)))
        mark = np.zeros(len(universe), np.int64)
        block, a, b = _Block(group, least), [], []
        for i, js in block.pairs():
            mine = flat[bounds[i]: bounds[i + 1]]
            mark[mine] = 1
            for j in js.tolist():
                if 100 * min(size[i], size[j]) < percent * max(size[i], size[j]):
                    continue
                if block.root(block.comp[i]) == block.root(block.comp[j]):
                    continue
                both = int(mark[flat[bounds[j]: bounds[j + 1]]].sum())
                if 100 * both >= percent * (size[i] + size[j] - both) and block.join(i, j):
                    a.append(rows[i])
                    b.append(rows[j])
            mark[mine] = 0
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=schema)

    return run


def _confirm(width: int, percent: int):
    """Links among the pairs of a group, on full sets."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        hasher, sets = WordHasher(SPACES), {}
        for batch in texts.combine_chunks().to_batches():
            for part in slices(batch, "text"):
                sets.update({_digest(s): s for s in shingle_sets(part["text"], width, hasher)})
        a, b = [], []
        for x, y in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
            s, t = sets[x], sets[y]
            if len(s) > len(t):
                s, t = t, s
            if 100 * len(s) < percent * len(t):
                continue
            spot = np.searchsorted(t, s)
            spot[spot == len(t)] = 0
            both = int((t[spot] == s).sum())
            if 100 * both >= percent * (len(s) + len(t) - both):
                a.append(x)
                b.append(y)
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=schema)

    return run


def _texts(rows: DataFrame, nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """``rows`` (by ``node``) with a text of each class. Equal doc_ids of different texts give rows
    too many; who reads the texts knows a class by its set."""
    rows = rows.join(nodes.select("node", F.col("doc_id").alias("rep")), "node")
    return documents.select("doc_id", "text").join(rows, documents["doc_id"].eqNullSafe(rows["rep"])).drop("doc_id", "rep")


def _links(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``home``, ``a``, ``b``) whose full sets are similar enough.

    Pairs of one bucket share texts, so they are dealt to groups by bucket: a text is moved
    once a group. A bucket of many pairs is split into blocks, so a group stays bounded.
    """
    pairs = durable(pairs.groupBy("a", "b").agg(F.min("home").alias("home")))
    total = pairs.count()
    groups = total // PAIRS_PER_GROUP + 1
    split = pairs.groupBy("home").agg(F.ceil(F.sqrt(F.count("*") / PAIRS_PER_GROUP)).alias("blocks"))
    dealt = durable(pairs.join(split, "home").select(
        "a", "b", F.pmod(F.xxhash64("home", F.pmod(F.xxhash64("a"), F.col("blocks")), F.pmod(F.xxhash64("b"), F.col("blocks"))),
                         F.lit(groups)).alias("grp")))
    wanted = dealt.select("grp", F.col("a").alias("node")).union(dealt.select("grp", "b")).distinct()
    texts = _texts(wanted.withColumnRenamed("grp", "to"), nodes, documents).select("to", "text")
    return dealt.groupBy("grp").cogroup(texts.groupBy("to")).applyInArrow(_confirm(width, percent), "a binary, b binary")


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """Groups of near-duplicate texts.

    ``documents`` needs ``doc_id`` and ``text``; other columns are ignored. Two texts are linked
    if 100 * |A & B| >= ``percent`` * |A | B| for their sets of ``width``-word shingles (A-Z
    lower-cased, words split at ASCII white space). Returns one row for each input row:
    ``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id of the group), ``kept`` (doc_id is
    that smallest one), ``root`` (names the group; null for an empty set) and ``text_hash`` (xxhash64).

    Null and empty texts, or texts without words, have empty sets and are linked with nothing;
    fewer words than ``width`` are one shingle. Repeated rows stay repeated and agree. A null
    doc_id counts only where its class has no other; then component_id is null and kept is true.
    Misses: a pair at the similarity shares no band with probability (1 - J^4)^32 (5e-8 at 0.8)
    and is pruned wrongly with probability ``miss`` a batch at most.
    """
    least = least_matches(percent / 100, miss)
    documents = documents.select("doc_id", "text")
    rows = stored(documents.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _describe(width), f"doc_id {dict(documents.dtypes)['doc_id']}, text_hash bigint, n_shingles bigint, node binary, buckets array<bigint>, sig binary"), "neardup-rows")
    filled = rows.where("n_shingles > 0")
    nodes = stored(filled.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("buckets").alias("buckets"),
                                              F.first("sig").alias("sig")), "neardup-nodes")
    slots = nodes.select("node", F.posexplode("buckets").alias("band", "bucket"))
    shared = slots.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    slots = stored(slots.join(shared, "bucket"), "neardup-slots")
    sig = nodes.select("node", "sig")

    star = (slots.where("node != pivot").groupBy(F.col("pivot").alias("a"), F.col("node").alias("b"))
            .agg(F.min("bucket").alias("home"))
            .join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))
    pairs = star.mapInArrow(_prune_pairs(least), "home bigint, a binary, b binary")
    links = durable(_links(pairs, nodes, documents, width, percent))
    roots = components(links)

    placed = slots.join(roots, "node", "left").select("bucket", "band", "node", "members", F.coalesce("root", "node").alias("comp"))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("bucket")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    marks = nodes.select("node", "sig", "buckets")
    past = F.slice("buckets", F.lit(1), F.col("band")).alias("past")
    open_slots = (placed.join(mixed, "bucket").join(marks, "node")
                  .withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                  .select("bucket", "band", "node", "comp", "sig", past, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                          F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side")))
    suspects = (open_slots.groupBy("bucket", "lo", "hi")
                .applyInArrow(_suspects(least), "bucket bigint, band int, lo int, hi int, side int, node binary, comp binary"))
    suspects = _texts(durable(suspects).join(marks, "node").select(*_SUSPECT, "sig", past), nodes, documents)
    rest = (suspects.groupBy("bucket", "lo", "hi")
            .applyInArrow(_confirm_block(width, percent, least), "a binary, b binary"))
    links = durable(links.unionByName(rest))
    roots = components(links)

    named = nodes.select("node", "doc_id").join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least_id = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = named.join(least_id, "root").select("node", "root", "component_id")
    out = rows.join(found, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "root", "text_hash")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, all columns kept: that of the smallest doc_id (then
    text hash). Of repeated rows one stays. Texts without words are no duplicates of each
    other, but repeated rows of one doc_id are.
    """
    found = near_duplicates(documents, width, percent)
    row = F.struct("doc_id", "text_hash")
    groups = found.where("n_shingles > 0").groupBy("root").agg(F.min(row).alias("row"))
    chosen = groups.select("row.*").unionByName(found.where("n_shingles = 0").select("doc_id", "text_hash")).distinct()
    many = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("many"))
    chosen = durable(chosen.alias("c").join(many.alias("m"), F.expr("c.doc_id <=> m.doc_id AND c.text_hash <=> m.text_hash"))
                     .select(F.col("c.doc_id").alias("_doc_id"), F.col("c.text_hash").alias("_text_hash"), "many"))
    same = F.expr("doc_id <=> _doc_id AND xxhash64(text) <=> _text_hash")
    rows = apart(documents)
    once = rows.join(chosen.where("many = 1"), same, "left_semi")
    again = rows.join(chosen.where("many > 1"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again).toDF(*documents.columns)
