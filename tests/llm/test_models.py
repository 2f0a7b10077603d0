from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import rows
from auditloom.llm import langid, toxicity
from auditloom.llm.common import table
from auditloom.llm.fst import Transducer
from auditloom.llm.queries import QUERIES

LARGE = "/root/testdata/sf0.01"
needs_large = pytest.mark.skipif(not os.path.isdir(LARGE), reason="test data is not here")


@needs_large
def test_language_of_rows_not_learned(spark):
    got = QUERIES["op10_language"](spark, LARGE).join(table(spark, LARGE, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95 and got["score"].between(0, 1).all()


def test_windows_cover_every_byte():
    for size in (0, 1, 255, 256, 257, 5000):
        raw = np.arange(1, size + 1) % 250 + 1
        windows, first = langid.cut(raw.astype(np.uint8), np.array([0, size]))
        step = langid.WINDOW - langid.REACH + 1
        seen = np.concatenate([w[: langid.WINDOW if k == len(windows) - 1 else step] for k, w in enumerate(windows)])
        assert first.tolist() == [0, len(windows)] and (seen[:size] == raw).all()


def test_language_of_awkward_rows(spark):
    net = langid.train(["the cat sat on the mat and the dog"] * 20 + ["der hund und die katze sind nicht im haus"] * 20, ["en"] * 20 + ["de"] * 20)
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(rows.documents(spark), net).collect()}
    assert {(5, "und"), (6, "und"), (7, "und"), (12, "und")} <= got and (1, "en") in got
    docs = rows.documents(spark)
    kept = langid.with_language(docs, net)
    assert kept.columns == docs.columns and {5, 6, 7, 12}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.with_language(docs, None).count() == sum(any(c.isalpha() for c in t or "") for _, t in rows.DOCUMENTS)
    assert langid.fit(docs.where("false")) is None and langid.predict(docs.where("false"), net).count() == 0


@needs_large
def test_toxicity_of_rows_not_learned(spark):
    got = QUERIES["op6_toxicity"](spark, LARGE).join(table(spark, LARGE, "labels"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.9
    assert held.loc[held["toxic"] == 1, "score"].mean() > held.loc[held["toxic"] == 0, "score"].mean() + 0.3


def plain_toxicity(model, text):
    """Every clause through the three transducers one after the other, without composition or search for words."""
    marks = dict.fromkeys(toxicity.MARKS, 0.0)
    clause = []
    for token in [*toxicity._TOKEN.findall(text.lower()), "."]:
        if token[0] not in ".!?;:\n":
            clause.append(token)
            continue
        symbols = [model.symbol(t) for t in clause]
        made = symbols
        for step in (toxicity.report_transducer(), toxicity.negation_transducer(), toxicity.target_transducer()):
            made = step.run(made)
        for mark, word in zip(made, clause):
            if mark in marks:
                marks[mark] += model.strength(word) if mark[0] == "I" else float(toxicity.TARGET in symbols)
        clause = []
    z = model.bias + sum(w * np.log1p(marks[m]) for m, w in zip(toxicity.MARKS, model.weights))
    return 1 / (1 + np.exp(-z))


@needs_large
def test_toxicity_matches_the_plain_scorer(spark):
    docs, labels = table(spark, LARGE, "documents"), table(spark, LARGE, "labels")
    model = toxicity.fit(docs.where(~toxicity.held_out()), labels.where(~toxicity.held_out()))
    extra = spark.createDataFrame(list(enumerate(["You idiot. He said \"you idiot\" and will kill you", "not an idiot; I will not kill you!", "They claimed he is stupid: kill him", None, ""], -9)),
                                  "doc_id bigint, text string")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").unionByName(extra)
    want = {r["doc_id"]: plain_toxicity(model, r["text"] or "") for r in docs.collect()}
    got = {r["doc_id"]: r["score"] for r in toxicity.predict(docs, model).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_texts_of_one_id_bring_one_row(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, "you idiot")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, toxic int")
    seen = []
    keep, toxicity.train = toxicity.train, lambda texts, toxic: seen.extend(texts)
    try:
        toxicity.fit(docs, labels)
    finally:
        toxicity.train = keep
    assert len(seen) == 2


def plain_language(net, text):
    """Mean probabilities by loops over windows, places and bytes."""
    raw, total, weights = text.encode(), 0.0, 0.0
    step, at = langid.WINDOW - langid.REACH + 1, 0
    widths = np.repeat(langid.WIDTHS, langid.FILTERS)
    while True:
        window = raw[at: at + langid.WINDOW].ljust(langid.WINDOW, b"\0")
        best = np.full(len(widths), -np.inf)
        for i in range(langid.WINDOW - langid.REACH + 1):
            sums = np.zeros(len(widths))
            for j in range(langid.REACH):
                sums += (net.embed[window[i + j]].astype(float) @ net.filters[j * langid.DEPTH: (j + 1) * langid.DEPTH].astype(float)) * (j < widths)
            best = np.maximum(best, sums)
        z = np.maximum(best + net.shift, 0) @ net.out.astype(float) + net.bias
        p = np.exp(z - z.max())
        weight = sum(b > 0 for b in window) + 1.0
        total, weights = total + weight * p / p.sum(), weights + weight
        at += step
        if at >= len(raw) - langid.REACH + 1:
            return total / weights


def test_language_matches_the_plain_convolution(spark):
    net = langid.train(["the cat sat on the mat and the dog"] * 20 + ["der hund und die katze sind nicht im haus"] * 20, ["en"] * 20 + ["de"] * 20)
    texts = [t[:9000] for _, t in rows.DOCUMENTS if t and any(c.isalpha() for c in t)] + ["é", "x" * 256, "the " * 64, "und " * 63, "das ist ein Haus, that is a house " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, net).collect()}
    for i, text in enumerate(texts):
        want = plain_language(net, text)
        assert abs(got[i][1] - want.max()) < 1e-4 and want[net.languages.index(got[i][0])] > want.max() - 1e-4, text[:40]


def test_composition_is_one_after_the_other():
    a = Transducer({(0, "x"): (1, "y"), (1, "x"): (0, "z")})
    b = Transducer({(0, "y"): (1, "p"), (1, "z"): (0, "q")})
    assert a.compose(b, "xw").run("xxwx") == b.run(a.run("xxwx")) == ["p", "q", "w", "p"]


@pytest.mark.parametrize("text, toxic", [
    ("You are a worthless idiot.", True), ("I will kill you", True), ("You will be shot. They murder you.", True), ("What an idiot!", True),
    ("He is not an idiot.", False), ("She said \"you are an idiot\".", False), ("They claimed he was stupid", False), ("He did not kill you.", False),
    ("The frost will kill the weeds.", False), ("die Katze und der Hund", False), ("", False), ("Hello world", False)])
def test_clauses(text, toxic):
    model = toxicity.train([], np.zeros(0, np.int64))
    assert (model.score(model.features(text, model.automaton())[None])[0] >= 0.5) == toxic


def test_words_are_learned_and_copies_teach_little():
    clean = [rows.sentence(k, 60) for k in range(200)]
    bad = [rows.sentence(900 + k, 20) + " flurbish " + rows.sentence(k, 20) for k in range(40)]
    copies = [clean[0] + " onlyhere"] * 40
    model = toxicity.train(clean + bad + copies, np.array([0] * 200 + [1] * 80))
    assert "flurbish" in model.words and "onlyhere" not in model.words


def test_toxicity_of_awkward_rows(spark):
    docs = rows.documents(spark)
    labels = spark.createDataFrame([(i, k % 2, k) for k, (i, _) in enumerate(rows.DOCUMENTS)] + [(1, None, 0), (99, 1, 0)], "doc_id bigint, toxic int, score int")
    got = toxicity.predict(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(rows.DOCUMENTS) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.predict(rows.documents(spark, []), toxicity.fit(docs, labels.where("false"))).count() == 0


def test_texts_of_several_languages_stay(spark):
    class Sure:
        languages = ["da", "de", "en", "fr"]

        def probabilities(self, windows):
            return np.array([[0.25] * 4 if (w == w.max()).sum() > 200 else np.eye(4)[int(w.max()) % 4] for w in windows], np.float32)

    docs = rows.documents(spark, [(1, "ae" * 126 + "ad" * 126 + "ac" * 126 + "ab" * 126), (2, "a" * 252), (3, "12"), (4, None)])
    got = {r["doc_id"]: r["score"] for r in langid.predict(docs, Sure()).collect()}
    assert got[1] < langid.LEAST_SCORE and got[2] < langid.LEAST_SCORE
    assert {r["doc_id"] for r in langid.with_language(docs, Sure()).collect()} == {1}
