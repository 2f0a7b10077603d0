"""Small awkward inputs."""

from __future__ import annotations

import random

WORDS = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which".split()


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") for _ in range(n))


BASE = sentence(1, 120)
PASSAGE = sentence(2, 14)

DOCUMENTS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE.replace(BASE.split()[60], "changed", 1)), (4, sentence(4, 90)), (5, None), (6, ""), (7, "   "),
    (8, "alone"), (9, "Alone"), (10, f"{sentence(5, 30)}. {PASSAGE.upper()}! {sentence(6, 30)}"), (11, PASSAGE), (12, "1234 !!!"),
    (None, "no id here"), (None, None), (13, " ".join(sentence(s, 400) for s in range(20, 50))), (14, "mail bob (at) example (dot) com, or a.b@c.org"),
    (15, "x" * 30000), (16, "wordé 中文 \U0001f600 \u0000 tail"),
]

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, spans string, ids string, node string, shard string, many string, _spans string, _items string, _n_words string, " \
    "_lang string, _score string, _sure string, _doc_id string, _text_hash string, _text string"


def documents(spark, rows=DOCUMENTS):
    """The rows with the columns of documents and some whose names operators use for their own."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), *"abcdefghijklmno") for i, t in rows], SCHEMA).repartition(3)
