"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes: insult, threat, target, negation, report. Transducers rewrite the class
string of a clause: the report transducer marks what follows a verb of saying or an opening
quote, the negation transducer what follows a negation closely, the target transducers what a
person stands near. Their composition turns each insult or threat into one marked symbol;
a clause's matches are its marked symbols, and each mark has a weight that is learned from
labels. Words of insult are learned from labels too, as whole words and as stems.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from auditloom.llm.common import durable, sampled_ids
from auditloom.llm.fst import Transducer
from auditloom.llm.words import slices

#: Bound of the labelled sample: clean and toxic rows.
ROWS_PER_LABEL = (8000, 4000)
#: Bound of the learned lexicon.
LEXICON = 20000

# Word classes that need no labels: English, German, French, Spanish.
TARGETS = frozenset("""you your yours yourself u he him his she her they them their these those people everyone all
du dich dir dein deine ihr euch euer sie ihnen alle tu te toi ton ta tes vous votre vos il elle ils elles leur tous
tú ti usted ustedes él ella ellos ellas su sus todos""".split())
NEGATIONS = frozenset("""not no never nobody none neither nor cannot can't don't doesn't didn't isn't aren't wasn't weren't won't wouldn't shouldn't
nicht kein keine keinen keiner nie niemals ne n' pas jamais aucun aucune nunca jamás tampoco ningún ninguna sin without ohne sans""".split())
REPORTS = frozenset("""said says say told tells wrote writes called calls claimed claims quoted quotes reported reports according alleged
sagte sagt schrieb nannte berichtet berichtete behauptet laut dit disait écrit affirme selon appelle dijo dice escribió llamó según afirma""".split())
QUOTES = frozenset("\"“„«»”")
INSULTS = frozenset("""idiot idiots moron morons imbecile stupid scum worthless pathetic loser losers disgusting trash clown clowns
vermin filth dumbass bastard bastards asshole bitch retard retarded freak subhuman parasite parasites pig pigs
dummkopf arschloch schwein abschaum versager salaud connard connasse crétin ordure imbécile cabrón pendejo estúpido basura""".split())
THREATS = frozenset("""kill murder shoot stab strangle destroy hurt slaughter exterminate rape bomb
töten umbringen erschießen verbrennen tuer crever égorger brûler matar matarte golpear morir""".split())

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[\"“„«»”]|[.!?;:\n]+")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_STEM = (4, 5, 6)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = "oITUNRQ"
ALPHABET = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE)
_MATCHES = (INSULT, THREAT)


def report_transducer() -> Transducer:
    """Marks insults and threats after a verb of saying, or inside quotes, with r."""
    arcs = {}
    for symbol in _MATCHES:
        for state in ("said", "quoted"):
            arcs[state, symbol] = state, symbol + "r"
    for state in (0, "said"):
        arcs[state, REPORT] = "said", OTHER
        arcs[state, QUOTE] = "quoted", OTHER
    arcs["quoted", QUOTE] = 0, OTHER
    arcs["quoted", REPORT] = "quoted", OTHER
    return Transducer(arcs)


def negation_transducer(reach: int = 3) -> Transducer:
    """Marks insults and threats at most ``reach`` words after a negation with n."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, NEGATION] = reach, OTHER
        for symbol in (OTHER, TARGET):
            arcs[left, symbol] = max(0, left - 1), symbol
        for symbol in ("I", "T", "Ir", "Tr"):
            arcs[left, symbol] = max(0, left - 1), symbol + "n" * (left > 0)
    return Transducer(arcs)


def target_transducer() -> Transducer:
    """Marks insults and threats that follow a target in the clause with u."""
    arcs = {(0, TARGET): (1, OTHER), (1, TARGET): (1, OTHER)}
    for symbol in ("I", "T", "Ir", "Tr", "In", "Tn", "Irn", "Trn"):
        arcs[1, symbol] = 1, symbol + "u"
    return Transducer(arcs)


@lru_cache(maxsize=1)
def grammar() -> Transducer:
    return report_transducer().compose(negation_transducer(), ALPHABET).compose(target_transducer(), ALPHABET)


MARKS = tuple(m + r + n + u for m in _MATCHES for r in ("", "r") for n in ("", "n") for u in ("", "u"))
_MARK = {m: i for i, m in enumerate(MARKS)}


@dataclass
class Toxicity:
    """A lexicon (words and stems of insults, with strengths) and the weights of the marks."""

    words: dict[str, float]
    stems: dict[str, float]
    weights: np.ndarray
    bias: float

    def strength(self, word: str) -> float:
        """Of a lower-case word; 0: no insult."""
        if word in self.words:
            return self.words[word]
        return max((self.stems.get(word[:n], 0.0) for n in _STEM), default=0.0)

    def symbol(self, token: str) -> str:
        if token in QUOTES:
            return QUOTE
        if self.strength(token):
            return INSULT
        for words, symbol in ((NEGATIONS, NEGATION), (REPORTS, REPORT), (TARGETS, TARGET), (THREATS, THREAT)):
            if token in words:
                return symbol
        return OTHER

    def automaton(self) -> ahocorasick.Automaton:
        """Finds where a word of the grammar that can match may begin."""
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word in {*self.words, *self.stems, *THREATS}:
            found.add_word(word, len(word))
        found.make_automaton()
        return found

    def features(self, text: str, automaton: ahocorasick.Automaton) -> np.ndarray:
        """How often each mark occurs in the clauses of a text, insults by their strength. A threat
        counts with a target in its clause only: before it (mark u) or after it."""
        out = np.zeros(len(MARKS))
        low = text.lower()
        if not any(end == size - 1 or not low[end - size].isalnum() for end, size in automaton.iter(low)):
            return out
        clause: list[str] = []
        for token in [*_TOKEN.findall(low), "."]:
            if token[0] not in ".!?;:\n":
                clause.append(token)
                continue
            symbols = [self.symbol(t) for t in clause]
            if INSULT in symbols or THREAT in symbols and TARGET in symbols:
                for made, word in zip(grammar().run(symbols), clause):
                    if made in _MARK:
                        out[_MARK[made]] += self.strength(word) if made[0] == INSULT else 1.0 if TARGET in symbols else 0.0
            clause = []
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.log1p(features) @ self.weights + self.bias)))


def _learn_lexicon(texts: list[str], toxic: np.ndarray) -> tuple[dict[str, float], dict[str, float]]:
    """Words, and stems shared by several words, that stand in toxic texts far more often than
    chance allows, hardly in clean ones, and in several surroundings (so copies of one toxic
    text teach little)."""
    counts: list[dict[str, int]] = [defaultdict(int), defaultdict(int)]
    for text, label in zip(texts, toxic):
        for w in set(_WORD.findall(text.lower())):
            counts[label][w] += 1
    share = math.log(max(1, int((toxic == 1).sum())) / len(texts))

    def telling(pos: int, neg: int, tested: int) -> bool:
        """Whether toxic texts could hold so many of the ``pos + neg`` by chance once in 20 times
        among ``tested`` words."""
        chance = pos * share + sum(math.log((pos + k) / k) for k in range(1, neg + 1))
        return pos >= 3 and neg <= 0.03 * pos and chance + math.log(tested) < math.log(0.05)

    clean, bad = counts
    words = {w for w, pos in bad.items() if telling(pos, clean.get(w, 0), len(bad))}
    stems: set[str] = set()
    many: dict[str, int] = {}
    for size in _STEM:
        pos, neg, kinds = defaultdict(int), defaultdict(int), defaultdict(int)
        for w, c in bad.items():
            if len(w) >= size:
                pos[w[:size]] += c
                kinds[w[:size]] += 1
        for w, c in clean.items():
            neg[w[:size]] += c
        found = {p: kinds[p] for p, c in pos.items() if kinds[p] >= 4 and telling(c, neg[p], len(pos))}
        # A longer stem of the same words says more.
        stems = {p for p in stems if not any(q.startswith(p) and found[q] == many[p] for q in found)} | found.keys()
        many |= found
    around: dict[str, set] = defaultdict(set)
    for text in (t for t, label in zip(texts, toxic) if label):
        found = _WORD.findall(text.lower())
        for i, w in enumerate(found):
            for key in (w, *(w[:n] for n in _STEM)):
                if (key in words or key in stems) and len(around[key]) < 16:
                    around[key].add((found[i - 1] if i else "", found[i + 1] if i + 1 < len(found) else ""))
    words = [w for w in words if len(around[w]) >= min(16, max(3, bad[w] // 2))]
    stems = [p for p in stems if len(around[p]) >= 4]
    words = sorted(words, key=lambda w: (-bad[w], w))[:LEXICON]
    return {w: 1.0 for w in words}, {p: 1.0 for p in sorted(stems)[:LEXICON]}


def _prior(mark: str) -> float:
    """Log-odds of a text with one match of a mark, before labels are seen: aimed and plain
    matches count, negated and reported ones don't."""
    if "n" in mark or "r" in mark:
        return -1.0 - ("n" in mark) - ("r" in mark)
    return 2.0 + ("u" in mark)


def train(texts: list[str], toxic: np.ndarray, steps: int = 400) -> Toxicity:
    """Fits lexicon and weights. A mark that no text of the sample shows gets the weight that
    gives one match its prior log-odds."""
    prior = np.array([_prior(m) for m in MARKS])
    start = (prior + 3.0) / math.log(2)
    if not len(toxic) or toxic.min() == toxic.max():
        return Toxicity({w: 1.0 for w in INSULTS}, {}, start, -3.0)
    words, stems = _learn_lexicon(texts, toxic)
    model = Toxicity({w: 1.0 for w in INSULTS} | words, stems, start, -3.0)
    automaton = model.automaton()
    x = np.log1p(np.array([model.features(t, automaton) for t in texts]))
    weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ model.weights + model.bias)))
        error = (p - toxic) * weight / len(toxic)
        model.weights = model.weights - 0.5 * (x.T @ error + 1e-3 * (model.weights - start))
        model.bias -= 0.5 * error.sum()
    unseen = x.sum(axis=0) == 0
    model.weights[unseen] = (prior[unseen] - model.bias) / math.log(2)
    return model


def fit(documents: DataFrame, labels: DataFrame, per_label: tuple[int, int] = ROWS_PER_LABEL) -> Toxicity:
    """A grammar from a bounded sample of the labelled rows: ``labels`` (``doc_id``, ``toxic`` 0 or 1) choose
    the ids, as many of each label as ``per_label`` says, and only their texts are read from
    ``documents``, one of each id. Equal texts count once, as toxic if any is."""
    labels = labels.where("toxic IN (0, 1)").select("doc_id", "toxic")
    ids = sampled_ids(labels, "toxic", dict(enumerate(per_label)))
    # The ids are bounded by ``per_label``, so the texts are not shuffled.
    chosen = durable(labels.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    got = (documents.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
           .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic").toPandas())
    got = got.groupby("text", as_index=False)["toxic"].max()
    return train(got["text"].tolist(), got["toxic"].to_numpy(np.int64))


def _apply(model: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [model.features(t or "", automaton) for t in part["text"].to_pylist()]
                score = model.score(np.array(found).reshape(-1, len(MARKS)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(score), pa.array([[m for m, c in zip(MARKS, f) if c] for f in found], pa.list_(pa.string()))],
                    names=["doc_id", "score", "marks"])

    return run


def predict(documents: DataFrame, model: Toxicity) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``marks`` (kinds of matches) of every whole text; other
    columns are ignored. A null text counts as empty: the score of a text without matches.
    Repeated rows stay repeated and agree. Texts without a match cost one scan.
    """
    return documents.select("doc_id", "text").mapInArrow(
        _apply(model), f"doc_id {dict(documents.dtypes)['doc_id']}, score double, marks array<string>")


def held_out() -> Column:
    """Rows whose labels are never learned."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
