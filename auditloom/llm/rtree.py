"""Hard negatives from STR-packed R-trees.

1. Rows are dealt by ranges of (label, first coordinate, id), so a tile holds a bounded number of
   rows even if many are equal. Inside its task a tile is packed by sort-tile-recursion: sorted by
   one coordinate after the other, cut into slabs, down to leaves; leaves are grouped into
   nodes. Leaves and nodes keep their minimum bounding box, their labels' range and smallest id.
2. A box bounds the inner product with an anchor by an interval, coordinate by coordinate:
   ``max(a * low, a * high)`` at most and ``min(a * low, a * high)`` at least.
3. A best-first queue opens boxes by falling bound. It drops a box outside the score window, and
   one strictly below the k-th best score found; at a tie with it only ids decide.
4. Each search runs twice: over one tile an anchor, which gives a k-th best score, then
   over the other tiles with that as the floor. The query set meets the tiles in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from auditloom.llm.common import stored

#: Rows of a tile, of a leaf, and boxes of a node; requests of a block.
TILE = 8192
LEAF = 128
FANOUT = 8
REQUESTS = 512

NONE = -(2**63)
_LOW, _HIGH = -(2**63), 2**63 - 1


def _pack(at: np.ndarray, vectors: np.ndarray, dims: list[int], leaf: int) -> list[np.ndarray]:
    """``at`` in leaves: sorted by the first of ``dims``, cut into slabs, each packed by the others."""
    if len(at) <= leaf:
        return [at]
    leaves = -(-len(at) // leaf)
    slabs = max(2, round(leaves ** (1 / max(1, min(len(dims), leaves.bit_length() - 1)))))
    at = at[np.argsort(vectors[at, dims[0]], kind="stable")]
    # Whole leaves in each slab but the last, as STR packs them.
    step = -(-leaves // slabs) * leaf
    out = []
    for i in range(0, len(at), step):
        out += _pack(at[i: i + step], vectors, dims[1:] or dims, leaf)
    return out


class Tree:
    """The boxes over the rows of one tile: leaves first, then nodes, the root last."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        # The widest coordinates are cut first. Rows come by label and id; sorts are stable.
        spread = np.asarray(vectors.max(axis=0) - vectors.min(axis=0), np.float64) if len(vectors) else np.zeros(0)
        dims = np.argsort(-spread, kind="stable").tolist()
        packs = []
        by_label = np.lexsort((ids, labels))
        for part in np.split(by_label, np.flatnonzero(np.diff(labels[by_label])) + 1):
            packs += _pack(part, vectors, dims, leaf)
        order = np.concatenate(packs)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        bounds = np.cumsum([0] + [len(p) for p in packs])
        self.leaves = [slice(a, b) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        boxes = [(self.vectors[s].min(axis=0), self.vectors[s].max(axis=0), self.labels[s].min(), self.labels[s].max(), self.ids[s].min()) for s in self.leaves]
        self.children: list[range] = [range(0)] * len(boxes)
        level = range(len(boxes))
        while len(level) > 1:
            above = []
            for i in range(level.start, level.stop, fanout):
                kids = range(i, min(i + fanout, level.stop))
                some = [boxes[k] for k in kids]
                above.append((np.min([b[0] for b in some], axis=0), np.max([b[1] for b in some], axis=0),
                              min(b[2] for b in some), max(b[3] for b in some), min(b[4] for b in some)))
                self.children.append(kids)
            level = range(len(boxes), len(boxes) + len(above))
            boxes += above
        self.low, self.high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])
        self.from_label, self.to_label, self.least = ([b[k] for b in boxes] for k in (2, 3, 4))

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with anything in each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(self, anchor_id: int, anchor: np.ndarray, label: int, same: bool, windows: list[list], least: list, most: list, k: int) -> list[list[tuple]]:
        """For each window ``[low, high, floor]`` the ``k`` best (-score, id) of it, of rows of the anchor's
        label (``same``) or of other labels; rows of ``anchor_id`` take no part. What scores under
        the floor is left out. ``least`` and ``most`` are the intervals of the boxes.
        """
        best: list[list[tuple]] = [[] for _ in windows]
        opened: dict[int, np.ndarray] = {}

        def wanted(box: int, w: int) -> bool:
            low, high, floor = windows[w]
            if most[box] < low or least[box] > high or most[box] < floor:
                return False
            if same and not self.from_label[box] <= label <= self.to_label[box] or not same and self.from_label[box] == label == self.to_label[box]:
                return False
            if len(best[w]) == k:
                score, last = -best[w][-1][0], best[w][-1][1]
                return most[box] > score or most[box] == score and self.least[box] < last
            return True

        root = len(self.children) - 1
        for w in range(len(windows)):
            queue = [(-most[root], self.least[root], root)]
            while queue:
                top, _, box = heapq.heappop(queue)
                if not wanted(box, w):
                    # Boxes that follow bound no more than this one; none of them can be above the k-th either.
                    if len(best[w]) == k and -top < -best[w][-1][0]:
                        break
                    continue
                if len(self.children[box]):
                    for child in self.children[box]:
                        if wanted(child, w):
                            heapq.heappush(queue, (-most[child], self.least[child], child))
                    continue
                rows = self.leaves[box]
                if box not in opened:
                    opened[box] = self.vectors[rows] @ anchor
                scores = opened[box]
                low, high, floor = windows[w]
                bar = max(low, floor, -best[w][-1][0] if len(best[w]) == k else floor)
                fit = (scores >= bar) & (scores <= high) & (self.ids[rows] != anchor_id)
                fit &= self.labels[rows] == label if same else self.labels[rows] != label
                at = np.flatnonzero(fit)
                if len(at):
                    found = best[w] + list(zip((-scores[at]).tolist(), self.ids[rows][at].tolist()))
                    found.sort()
                    best[w] = found[:k]
        return best


def _numbers(flat: pa.Array, rows: int) -> np.ndarray:
    """Vectors of a tile as whole numbers: doubles where they and all inner products are exact, else Python integers."""
    vectors = np.asarray(flat).reshape(rows, -1)
    most = np.abs(vectors).max(initial=0)
    if most * most * max(1, vectors.shape[1]) < 2.0**53:
        return vectors
    return np.array([int(x) for x in vectors.ravel()], dtype=object).reshape(vectors.shape)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, ordered by dims, label and first coordinate, cut into tiles."""
    def tile(rows: pa.Table) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([rows["dims"][0].as_py()], pa.int32()), pa.array([rows[c].to_pylist() for c in ("vec_id",)], pa.list_(pa.int64())),
             pa.array([rows["label"].to_pylist()], pa.list_(pa.int64())),
             pa.ListArray.from_arrays(pa.array([0, len(rows) * rows["dims"][0].as_py()], pa.int32()), rows["v"].combine_chunks().flatten()),
             pa.array([sorted(set(rows["label"].to_pylist()))], pa.list_(pa.int64()))], names=["dims", "ids", "labels", "flat", "has"])

    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        cuts = [0, *(np.flatnonzero(np.diff(np.asarray(batch["dims"]))) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            while a < b:
                if held and held[0]["dims"][0] != batch["dims"][a] or count == TILE:
                    yield tile(pa.Table.from_batches(held))
                    held, count = [], 0
                take = min(b - a, TILE - count)
                held.append(batch.slice(a, take))
                count += take
                a += take
    if held:
        yield tile(pa.Table.from_batches(held))


def _search(k: int, same: bool):
    """Requests of a block against their tile. A tile's tree is packed once for the requests that follow it."""
    names = ["anchor_id", "window", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for row in range(len(batch)):
                if batch["tile"][row].as_py() != last:
                    last = batch["tile"][row].as_py()
                    ids = np.asarray(batch["ids"][row].values)
                    tree = Tree(ids, np.asarray(batch["labels"][row].values), _numbers(batch["flat"][row].values, len(ids)))
                asked = batch["requests"][row].as_py()
                if not asked:
                    continue
                anchors = _numbers(pa.array([x for r in asked for x in r["v"]], pa.float64()), len(asked))
                if anchors.dtype == object or tree.vectors.dtype == object or \
                        np.abs(anchors).max(initial=0) * np.abs(tree.vectors).max(initial=0) * anchors.shape[1] >= 2.0**53:
                    exact = lambda m: m if m.dtype == object else np.array([int(x) for x in m.ravel()], dtype=object).reshape(m.shape)
                    anchors, tree.vectors, tree.low, tree.high = map(exact, (anchors, tree.vectors, tree.low, tree.high))
                least, most = tree.intervals(anchors)
                out = []
                for r, anchor, lo, hi in zip(asked, anchors, least.tolist(), most.tolist()):
                    windows = [[w["low"], w["high"], w["floor"]] for w in r["windows"]]
                    found = tree.search(r["anchor_id"], anchor, r["label"], same, windows, lo, hi, k)
                    out += [(r["anchor_id"], w["window"], i, min(_HIGH, max(_LOW, int(-s)))) for w, some in zip(r["windows"], found) for s, i in some]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.int64()))], names=names)

    return run


def _meet(requests: DataFrame, tiles: DataFrame, k: int, same: bool) -> DataFrame:
    """The best ``k`` a request and window: over one tile of its label (or of others), then over the rest
    with the k-th best found there as the floor."""
    # As many rows as there are tiles, without their vectors. ``part`` is what blocks and tiles must share:
    # the label, or nothing.
    parts = tiles.select("dims", "tile", F.explode("has").alias("part")) if same else tiles.select("dims", "tile", F.lit(0).cast("bigint").alias("part"))
    targets = parts.withColumn("at", F.expr("row_number() OVER (PARTITION BY dims, part ORDER BY tile)").cast("bigint") - 1)
    targets = stored(targets, "rtree-targets")
    sizes = targets.groupBy("dims", "part").agg(F.count("*").alias("of"))
    asked = requests.withColumn("part", F.col("label") if same else F.lit(0).cast("bigint"))
    blocks = asked.groupBy("dims", "part").agg(F.ceil(F.count("*") / REQUESTS).cast("int").alias("blocks")).join(sizes, ["dims", "part"])
    asked = (asked.join(blocks, ["dims", "part"]).withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.col("blocks")).cast("int"))
             .withColumn("first", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.col("of"))))
    request = F.struct("anchor_id", "label", "v", "windows")

    def search(met: DataFrame) -> DataFrame:
        # Each block is a row with its tile's; a task takes a tile's blocks one after the other.
        rows = met.join(tiles.select("tile", "ids", "labels", "flat"), "tile")
        return rows.select("tile", "ids", "labels", "flat", "requests").mapInArrow(
            _search(k, same), "anchor_id bigint, window bigint, vec_id bigint, score bigint")

    home = (asked.groupBy("dims", "part", "block", F.col("first").alias("at")).agg(F.collect_list(request).alias("requests"))
            .join(targets, ["dims", "part", "at"]).select("tile", "requests"))
    near = stored(search(home), "rtree-near")
    kth = near.groupBy("anchor_id", "window").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") >= k)
    floors = kth.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors"))
    raised = (asked.join(floors, "anchor_id", "left")
              .withColumn("windows", F.transform("windows", lambda w: w.withField("floor", F.coalesce(F.try_element_at("floors", w["window"]), w["floor"])))))
    packed = raised.groupBy("dims", "part", "block", "first", "of").agg(F.collect_list(request).alias("requests"))
    # One row a block and tile; the list of tiles is a number range, so no join multiplies rows.
    rest = (packed.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("of") - 1))).where("at != first")
            .join(targets, ["dims", "part", "at"]).select("tile", "requests"))
    found = near.unionByName(search(rest))
    rank = F.expr("row_number() OVER (PARTITION BY anchor_id, window ORDER BY score DESC, vec_id)").cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, scale: int = 256,
                   low: int = 30, high: int = 90, label: str = "label") -> DataFrame:
    """For each anchor (rows whose ``vec_id`` is divisible by ``every``) and each of its first ``positives`` rows
    of the same label, the first ``negatives`` rows of other labels that satisfy
    ``low * positive_score <= 100 * negative_score <= high * positive_score``: ``anchor_id``, ``positive_id``,
    ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    A score is the inner product of the vectors ``floor(scale * x)``; higher ones come first, ties by smaller
    ``vec_id``. Rows with a null id, label or vector, an empty vector, or a null or non-finite component
    take no part; vectors of different dimension are not compared. Rows with the anchor's id are
    its own; of anchors with one id the smallest (vector, label) asks. An anchor without positives, or with
    none of fitting negatives, has no rows; repeated rows count each. Scores beyond 64 bits are clipped
    to them. ``vectors`` needs ``vec_id``, ``embedding`` and the column ``label``; others are ignored.
    """
    rows = (vectors.where("vec_id IS NOT NULL AND size(embedding) > 0").where(F.col(label).isNotNull())
            .where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.size("embedding").alias("dims"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v")))
    parts = max(1, -(-rows.count() // (4 * TILE)))
    dealt = (rows.withColumn("x", F.col("v")[0]).repartitionByRange(parts, "dims", "label", "x", "vec_id")
             .sortWithinPartitions("dims", "label", "x", "vec_id"))
    tiles = dealt.select("dims", "vec_id", "label", "v").mapInArrow(
        _tiles, "dims int, ids array<bigint>, labels array<bigint>, flat array<double>, has array<bigint>")
    tiles = stored(tiles.withColumn("tile", F.monotonically_increasing_id()), "rtree-tiles")

    anchors = (rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("anchor_id"))
               .agg(F.min(F.struct("v", "label", "dims")).alias("a")).select("anchor_id", "a.v", "a.label", "a.dims"))
    window = "struct<window: bigint, low: bigint, high: bigint, floor: bigint>"
    whole = F.array(F.struct(F.lit(0).alias("window"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high"), F.lit(_LOW).alias("floor")).cast(window))
    first = _meet(anchors.withColumn("windows", whole), tiles, positives, True)
    first = stored(first.select("anchor_id", F.col("rank").cast("bigint").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                   "rtree-positives")

    wide = F.col("positive_score").cast("decimal(38,0)")
    bounds = F.struct("window", F.ceil(wide * low / 100).cast("bigint").alias("low"), F.floor(wide * high / 100).cast("bigint").alias("high"), F.lit(_LOW).alias("floor"))
    asked = first.where("positive_score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_list(bounds)).cast(f"array<{window}>").alias("windows"))
    found = _meet(anchors.join(asked, "anchor_id"), tiles, negatives, False)
    return found.join(first, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
