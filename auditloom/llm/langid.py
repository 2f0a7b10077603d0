"""Language identification by a byte convolutional network, trained and applied in numpy.

A window of bytes is embedded, filters of several widths slide over it, each filter's maximum
over the window feeds one softmax layer. A text is cut into windows that cover all of it; its
probabilities are the mean over its windows, weighted by their bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from auditloom.llm.common import apart, sampled_ids
from auditloom.llm.words import slices, utf8

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
DEPTH = 8
REACH = max(WIDTHS)
#: Bounds of the training sample: rows of each language, and windows of each row.
ROWS_PER_LANGUAGE = 500
WINDOWS_PER_ROW = 4
EPOCHS = 8
BATCH = 64
UNKNOWN = "und"
#: Texts whose windows are less sure than this in the mean, each of its own language, are taken for no language.
LEAST_SCORE = 0.4
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class ByteNet:
    """Weights. ``filters`` holds all widths in one matrix over ``REACH`` embedded bytes; rows
    beyond a filter's width are zero."""

    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def _columns(self, windows: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(self.embed[windows]).reshape(len(windows), -1)
        steps = windows.shape[1] - REACH + 1
        view = np.lib.stride_tricks.as_strided(
            x, (len(x), steps, REACH * DEPTH), (x.strides[0], DEPTH * x.itemsize, x.itemsize), writeable=False)
        return view.reshape(-1, REACH * DEPTH)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cols = self._columns(windows)
        sums = (cols @ self.filters).reshape(len(windows), -1, self.filters.shape[1])
        return np.maximum(sums.max(axis=1) + self.shift, 0), sums, cols

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows)[0] @ self.out + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def cut(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover every text, the last one padded with zeros, and the number of windows
    before each text. Windows overlap by a filter's reach; every text has one at least."""
    step = WINDOW - REACH + 1
    size = np.diff(bounds)
    many = np.maximum(1, -(-(size - REACH + 1) // step))
    first = np.concatenate(([0], np.cumsum(many)))
    start = (np.arange(first[-1]) - np.repeat(first[:-1], many)) * step + np.repeat(bounds[:-1], many)
    place = start[:, None] + np.arange(WINDOW)
    windows = np.zeros(place.shape, np.uint8)
    ok = place < np.repeat(bounds[1:], many)[:, None]
    windows[ok] = raw[place[ok]]
    return windows, first


def train(texts: list[str], labels: list[str], epochs: int = EPOCHS, seed: int = 7) -> ByteNet:
    """Fits a network by Adam on the windows of ``texts``. The gradient of a maximum reaches only
    the place that gave it, so the backward pass is small."""
    languages = sorted(set(labels))
    raw, bounds = utf8(pa.array(texts, pa.string()))
    windows, first = cut(raw, bounds)
    target = np.repeat([languages.index(x) for x in labels], np.diff(first)).astype(np.int64)
    rng = np.random.default_rng(seed)
    n = FILTERS * len(WIDTHS)
    width = np.repeat(WIDTHS, FILTERS)
    mask = (np.arange(REACH * DEPTH)[:, None] < width[None, :] * DEPTH).astype(np.float32)
    net = ByteNet(languages, rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
                  rng.normal(0, 0.3, (REACH * DEPTH, n)).astype(np.float32) * mask, np.zeros(n, np.float32),
                  rng.normal(0, 0.1, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    names = ("embed", "filters", "shift", "out", "bias")
    first_moment = {k: np.zeros_like(getattr(net, k)) for k in names}
    second_moment = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            pick = order[at: at + BATCH]
            x, y = windows[pick], target[pick]
            pooled, sums, cols = net.pooled(x)
            z = pooled @ net.out + net.bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.out.T) * (pooled > 0)
            best = sums.argmax(axis=1)
            rows = best + np.arange(len(x))[:, None] * sums.shape[1]
            seen = cols[rows]
            grad = {"out": pooled.T @ error, "bias": error.sum(axis=0), "shift": back.sum(axis=0),
                    "filters": np.einsum("bf,bfk->kf", back, seen) * mask}
            spread = (back[:, :, None] * net.filters.T[None]).reshape(-1, REACH, DEPTH)
            places = (best[:, :, None] + np.arange(REACH)).reshape(-1, REACH)
            codes = x[np.repeat(np.arange(len(x)), n)[:, None], places]
            grad["embed"] = np.zeros_like(net.embed)
            np.add.at(grad["embed"], codes, spread)
            step += 1
            for k in names:
                g = grad[k].astype(np.float32) + 1e-4 * getattr(net, k)
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
                second_moment[k] = 0.99 * second_moment[k] + 0.01 * g * g
                getattr(net, k)[...] -= 0.01 * (1 - epoch / epochs) * (first_moment[k] / (1 - 0.9**step)) / (
                    np.sqrt(second_moment[k] / (1 - 0.99**step)) + 1e-8)
            net.filters *= mask
    return net


def sample(rows: DataFrame, per_language: int = ROWS_PER_LANGUAGE, per_row: int = WINDOWS_PER_ROW) -> DataFrame:
    """Stretches of labelled texts (``lang``, ``piece``): ``per_language`` rows of each language by
    the hash of the id, ``per_row`` evenly spaced stretches of each: of a window's length, the
    second of a quarter of it."""
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    # The ids are bounded, so the texts are not shuffled.
    rows = rows.join(F.broadcast(sampled_ids(rows, "lang", per_language)), "doc_id", "left_semi")
    room = F.greatest(F.length("text") - WINDOW, F.lit(0))
    spot = F.floor(room * F.col("k") / max(1, per_row - 1)).cast("int")
    return (rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(per_row - 1))))
            .select("lang", "text", "k", spot.alias("spot"))
            .select("lang", F.expr(f"substring(text, spot + 1, IF(k = 1, {WINDOW // 4}, {WINDOW}))").alias("piece")).distinct())


def fit(rows: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> ByteNet | None:
    """A network for the languages of the labelled ``rows`` (``doc_id``, ``text``, ``lang``), from a
    bounded sample of them; None if there are none."""
    got = sample(rows, per_language).toPandas().sort_values(["lang", "piece"])
    return train(got["piece"].tolist(), got["lang"].tolist()) if len(got) else None


def _apply(net: ByteNet | None, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                names, scores, sure = [UNKNOWN] * len(part), np.zeros(len(part)), np.zeros(len(part))
                has = np.array([bool(t and _LETTER.search(t)) for t in part["text"].to_pylist()])
                if net and has.any():
                    windows, first = cut(*utf8(part["text"].filter(pa.array(has))))
                    p = np.concatenate([net.probabilities(windows[i: i + BATCH]) for i in range(0, len(windows), BATCH)])
                    weight = (windows > 0).sum(axis=1, keepdims=True) + 1.0
                    mean = np.add.reduceat(p * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
                    sure[has] = (np.add.reduceat(p.max(axis=1, keepdims=True) * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]))[:, 0]
                    best = mean.argmax(axis=1)
                    scores[has] = np.clip(mean[np.arange(len(mean)), best], 0, 1)
                    for i, k in zip(np.flatnonzero(has), best):
                        names[i] = net.languages[k]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in keep), pa.array(names), pa.array(scores), pa.array(sure)], names=[*keep, "_lang", "_score", "_sure"])

    return run


def _predicted(documents: DataFrame, net: ByteNet | None, keep: list[str]) -> DataFrame:
    kinds = dict(documents.dtypes)
    return documents.select(*[f"`{c}`" for c in {*keep, "text"}]).mapInArrow(
        _apply(net, keep), ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", _lang string, _score double, _sure double")


def predict(documents: DataFrame, net: ByteNet | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every whole text; other columns are ignored.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if there
    was nothing to learn from. Repeated rows stay repeated and agree.
    """
    return _predicted(documents, net, ["doc_id"]).select("doc_id", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def with_language(documents: DataFrame, net: ByteNet | None, least: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``documents``, all columns kept, whose text has known languages: not ``und``, and in
    the mean over its windows a best probability of ``least`` or more, so a text of several
    languages stays. Without a network (nothing to learn from) only texts without a
    letter go."""
    if net is None:
        return documents.where(F.col("text").rlike(r"\p{L}"))
    rows = apart(documents)
    found = _predicted(rows, net, rows.columns).where((F.col("_lang") != UNKNOWN) & (F.col("_sure") >= least))
    return found.select(*[f"`{c}`" for c in rows.columns]).toDF(*documents.columns)


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
