"""Personal data with offsets: detectors on the text, and on a normalised text mapped back.

The detectors of the four kinds run on the text itself. Then transducers rewrite what hides
an identifier: look-alike and full-width characters, digits spelled as words, and words or
brackets that stand for @ and dot. Each rewrite keeps which source characters it came from,
so a span found in the normalised text maps back to code points of the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from auditloom.llm.words import slices

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Digit runs can't be entered in the middle after a failure, so the look-behind changes no match
# and keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the @
    so that long runs without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (twice + sum(map(int, digits[-1::-2]))) % 10 == 0


def detect(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by kind, then start; end exclusive."""
    out = [("email", *span) for span in emails(text)]
    if not _ANY_DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


#: Characters that look like an ASCII one, besides those that compatibility decomposition gives.
LOOK_ALIKE = dict(zip("АВЕКМНОРСТУХаеорсухіјѕԁһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαιν٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹०१२३४५६७८९‐‑‒–—−․。·∙",
                      "ABEKMHOPCTYXaeopcyxijsdhlABEZHIKMNOPTYXoaiv012345678901234567890123456789------....", strict=True))
LOOK_ALIKE |= {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFF01, 0xFF5F), 0x3000, *range(0x1D400, 0x1D800), *range(0x2460, 0x2469), 0x2070, *range(0x2074, 0x207A), *range(0x2080, 0x208A))
               if len(unicodedata.normalize("NFKC", chr(c))) == 1 and unicodedata.normalize("NFKC", chr(c)).isascii()}
#: Characters that show nothing.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Digits as words: English, German, French, Spanish.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
AT_WORDS = ("at", "arroba", "arobase", "ät")
DOT_WORDS = ("dot", "punkt", "punto", "point")
#: Words for a sign inside a name, and character references by name.
NAME_WORDS = {"dot": ".", "punkt": ".", "punto": ".", "underscore": "_", "unterstrich": "_", "dash": "-", "hyphen": "-"}
REFERENCES = {"commat": "@", "period": ".", "plus": "+", "lowbar": "_"}

#: Longer last labels of a host that is spelled in part; any of two letters will do besides.
ENDINGS = """com org net edu gov mil int arpa info biz name pro aero coop museum jobs mobi travel tel cat asia post xxx example test
app dev page blog shop store online site website web tech technology cloud digital agency company business services solutions
systems software network email mail chat social media news press tv live studio design art photo photos photography gallery video
film movie music radio audio band theater game games fun play club team group community foundation charity church school academy
college university education training institute science engineering energy solar green eco earth garden farm food restaurant cafe
bar pub pizza kitchen recipes beer wine coffee hotel holiday vacations flights tours cruise taxi car cars auto bike boats parts
repair tools supply equipment builders construction contractors house homes property properties estate realestate apartments
rentals land immo haus immobilien bank finance financial capital fund money cash credit loan loans insurance tax accountant
accountants lawyer legal attorney law consulting management marketing partners ventures holdings enterprises industries
international global world city town london paris berlin hamburg koeln cologne wien tokyo nyc miami vegas boston amsterdam
brussels barcelona madrid sydney melbourne africa scot wales irish swiss bayern saarland ruhr nrw corsica eus gal bzh quebec lat
xyz top icu vip win bid loan men click link download stream party racing review reviews trade date faith cricket science work
works life love today one zone space host hosting domains center support help guide wiki how expert guru ninja rocks cool buzz
best plus gold diamonds jewelry fashion clothing shoes boutique style beauty hair salon makeup skin spa health healthcare care
clinic dental dentist doctor hospital medical vet fitness yoga run surf golf tennis football soccer hockey fit dog pet kids baby
family mom dad wedding gift gifts toys cards poker casino bet lotto sale deals discount promo market markets shopping express
delivery direct limited ltd llc inc gmbh srl sarl kaufen versicherung gratis voto vote democrat republican army navy airforce
black blue red pink observer report ink computer codes code bot data host security safe protection camera mobile phone
smart cyou monster quest sbs cfd bond lol wtf foo ooo moe moi dating sexy adult porn google amazon apple microsoft bmw
youtube gmail aws""".split()
#: Those of them that may follow "point", "punkt" or "punto".
PLAIN_ENDINGS = "com org net edu gov mil info biz app dev example test".split()
#: Words of two letters that end no host, and words that may end one but also follow "point" in a sentence.
NO_ENDINGS = "ah an eh go ha he hi ho if of oh ok on or ox uh um up we ye yo".split()
WORD_ENDINGS = "in it is at us be me my no so to as am by do la le il tu te se un et ou si ne du da ab im es".split()
#: Words before "point" or "dot" in a sentence, and before "at" and an address of the web.
DETERMINERS = "the a an this that these those some any each every no one which what another its his her their my your our".split()
BEFORE_ADDRESS = """us me him her them it look looking looks shop shopping available more found find visit read reading buy sold sale
online information details here there website site web page homepage located hosted live is are was were be and or order watch
download register join arrive arrived working works work worked stay stop click see learn check apply donate today now free story
article originally published posted appeared""".split()

# A set of few ranges is searched fast; the tables then tell which of these characters count.
_ODD = re.compile("[\\xad\\xb7\\u0370-\\U0010ffff]")
_SPELLED = "|".join(sorted(SPELLED, key=len, reverse=True))
# A spelled digit counts in a run of four digits or more, spelled or not.
_DIGIT_RUN = re.compile(rf"(?<!\w)(?:(?:{_SPELLED})|[0-9]+)(?:[\x20().-]{{1,3}}(?:(?:{_SPELLED})(?!\w)|[0-9]+)){{3,}}(?!\w)", re.I)
_SPELLED_WORD = re.compile(rf"(?<!\w)(?:{_SPELLED})(?!\w)", re.I)
# Blanks before a bracket are taken from the start of their run, or a long run would be read from each of its places.
_BRACKETED = re.compile(rf"(?:(?<!\s)\s++)?[(\[{{<]\s*+(?:(?P<at>{'|'.join(AT_WORDS)}|@)|(?P<dot>{'|'.join(DOT_WORDS)}|\.))\s*+[)\]}}>]\s*+", re.I)
# Bare words count in the shape: name at host dot name, with signs for some of them.
_POINT_WORDS = "|".join(w for w in DOT_WORDS if w != "dot")
_WORDED = re.compile(rf"""(?<![\w.%+-])(?P<name>[a-z0-9._%+-]++)(?:(?P<at>\s+(?:{'|'.join(AT_WORDS)})\s+)|(?P<sign>\s*@\s*))
    (?!(?:{'|'.join(DETERMINERS)})\s)(?P<host>(?:[a-z0-9-]++(?:\.|\s+(?:{'|'.join(DOT_WORDS)})\s+))*[a-z0-9-]++
    (?:(?:\.|\s+dot\s+)(?:(?!(?:{'|'.join(NO_ENDINGS)})(?!\w))[a-z]{{2}}|{'|'.join(ENDINGS)})
    |\s+(?:{_POINT_WORDS})\s+(?:de|es|se|(?!(?:{'|'.join(NO_ENDINGS + WORD_ENDINGS)})(?!\w))[a-z]{{2}}|{'|'.join(PLAIN_ENDINGS)})))
    (?!\w|[/:]\w)""", re.I | re.X)
_PLAIN_HOST = re.compile(rf"\s(?:{'|'.join(AT_WORDS)})\s+[a-z0-9-]+\.[a-z0-9]", re.I)
_DOT = re.compile(rf"\s+(?:{'|'.join(DOT_WORDS)})\s+", re.I)
_BETWEEN = re.compile(rf"(?<!\w)(?:{_SPELLED}|[0-9]+)(?P<dot>\s+(?:{'|'.join(DOT_WORDS)})\s+)(?=(?:{_SPELLED}|[0-9]+)(?!\w))", re.I)
_SPACED = re.compile(r"(?<=[A-Za-z0-9])\s+@\s+(?=[A-Za-z0-9-]+\.[A-Za-z])")
_REFERENCE = re.compile(rf"&(?:#0{{0,5}}(?P<decimal>[0-9]{{2,3}})|#x0{{0,5}}(?P<hex>[0-9a-f]{{2}})|(?P<name>{'|'.join(REFERENCES)}));", re.I)
_PLUS = re.compile(rf"(?<!\w)plus\s{{1,3}}(?=[0-9]|(?:{_SPELLED})(?!\w))", re.I)
# "(a)" counts between a name and a host that touch it.
_BRACKETED_A = re.compile(r"(?<=[a-z0-9])[(\[{]a[)\]}](?=[a-z0-9-]++\.[a-z])", re.I)
_SPACED_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s*+\.\s*+[0-9]{1,3}){3}(?!\w|\.[0-9])")
# A host cut by blanks around its dots, behind an @; lower-case endings, or the next sentence would be one.
_END = rf"(?:(?!(?:{'|'.join(NO_ENDINGS)})(?!\w))[a-z]{{2}}|{'|'.join(ENDINGS)})(?!\w)"
_PARTED = re.compile(rf"(?<=[A-Za-z0-9])\s*+@\s*+(?P<host>[A-Za-z0-9-]++(?:(?:\.|\s+\.\s+)[A-Za-z0-9-]++)*?(?:\.|\s+\.\s+){_END}(?:\s+\.\s+[a-z]{{2}}(?!\w))?)")
_PARTED_DOT = re.compile(r"(?<!\s)\s++\.\s++")
_NAME_PART = re.compile(rf"(?<![\w.%+-])(?P<part>[a-z0-9._%+-]{{1,64}})(?P<sign>\s{{1,3}}(?P<word>{'|'.join(NAME_WORDS)})\s{{1,3}})$", re.I)
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_WORDS = re.compile(r"\w+").findall
_BEFORE_ADDRESS = frozenset(BEFORE_ADDRESS)
_DIGIT_WORDS, _SIGN_WORDS = frozenset(SPELLED), frozenset(DOT_WORDS)
_ANY_DIGIT = re.compile("[0-9]")


def _may_hide(text: str) -> bool:
    """Whether any transducer can change ``text``: cheap tests for what each of them needs."""
    if not text.isascii() and any(c in LOOK_ALIKE or c in INVISIBLE for c in set(_ODD.findall(text))):
        return True
    if any(c in text for c in "([{<") and _BRACKETED.search(text):
        return True
    if "@" in text and ("@ " in text or _SPACED.search(text) or _PARTED_DOT.search(text)):
        return True
    if "&" in text and _REFERENCE.search(text) or " ." in text and _SPACED_IP.search(text):
        return True
    if "a" in text and _BRACKETED_A.search(text) or "plus" in text.lower() and _PLUS.search(text):
        return True
    if "." in text and _PLAIN_HOST.search(text):
        return True
    words = set(_WORDS(text.lower()))
    return not (words.isdisjoint(_DIGIT_WORDS) and words.isdisjoint(_SIGN_WORDS))


class Mapped:
    """A text with, for each stretch of characters, the stretch of the source it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.at = [0]
        self.source = [(0, 1)]  # start in the source, and step: 1 in copied stretches, 0 in rewritten ones
        self.width = [0]

    def start(self, i: int) -> int:
        k = bisect_right(self.at, i) - 1
        start, step = self.source[k]
        return start + step * (i - self.at[k])

    def end(self, i: int) -> int:
        """End in the source of what gave the character before ``i``."""
        k = bisect_right(self.at, i - 1) - 1
        start, step = self.source[k]
        return start + (i - self.at[k] if step else self.width[k])

    def rewrite(self, edits: list[tuple[int, int, str]]) -> "Mapped":
        """The text with stretches (start, end, output) replaced, in order, without overlap."""
        if not edits:
            return self
        out, pieces, size, last = Mapped(""), [], 0, 0
        out.at, out.source, out.width = [], [], []

        def copy(lo: int, hi: int) -> None:
            nonlocal size
            while lo < hi:
                k = bisect_right(self.at, lo) - 1
                stop = min(hi, self.at[k + 1] if k + 1 < len(self.at) else hi)
                start, step = self.source[k]
                out.at.append(size)
                out.source.append((start + step * (lo - self.at[k]), step))
                out.width.append(self.width[k])
                pieces.append(self.text[lo:stop])
                size += stop - lo
                lo = stop

        for lo, hi, new in edits:
            copy(last, lo)
            if new:
                start = self.start(lo)
                out.at.append(size)
                out.source.append((start, 0))
                out.width.append(self.end(hi) - start)
                pieces.append(new)
                size += len(new)
            last = hi
        copy(last, len(self.text))
        out.text = "".join(pieces)
        if not out.at:
            return Mapped("")
        return out


def _characters(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), LOOK_ALIKE.get(m[0], "")) for m in _ODD.finditer(text) if m[0] in LOOK_ALIKE or m[0] in INVISIBLE]


def _references(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _REFERENCE.finditer(text):
        sign = REFERENCES[m["name"].lower()] if m["name"] else chr(int(m["decimal"]) if m["decimal"] else int(m["hex"], 16))
        if "\x20" < sign < "\x7f":
            out.append((m.start(), m.end(), sign))
    return out


def _letters(text: str) -> list[tuple[int, int, str]]:
    """Blanks between single characters around an @: ``a b @ c . d e``."""
    out, last, at = [], 0, text.find(" @ ")
    while at >= 0:
        lo, hi = at, at + 2
        while lo - 1 >= last and text[lo - 1] in _LETTERS and (lo - 1 == 0 or text[lo - 2].isspace()):
            lo -= 2
        while hi + 1 < len(text) and text[hi] == " " and text[hi + 1] in _LETTERS and not text[hi + 2: hi + 3].isalnum():
            hi += 2
        lo = max(lo + 1, last)
        if at - lo >= 3 and " . " in text[at + 3: hi]:
            out += [(i, i + 1, "") for i in range(lo, hi) if text[i] == " "]
        last = max(hi, at + 2)
        at = text.find(" @ ", last - 1)
    return out


def _plus(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]


def _digits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for run in _DIGIT_RUN.finditer(text):
        at = run.start()
        parts = [(m.start(), m.end(), SPELLED[m[0].lower()]) for m in _SPELLED_WORD.finditer(text, run.start(), run.end())]
        # Spelled digits stand together: spaces beside one go, other signs stay.
        for start, end, digit in parts:
            while start > at and text[start - 1] == " ":
                start -= 1
            while end < run.end() and text[end] == " ":
                end += 1
            out.append((start, end, digit))
            at = end
    return out


def _signs(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "@") for m in _BRACKETED_A.finditer(text)]
    return sorted(out + [(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(text)])


def _worded(text: str) -> list[tuple[int, int, str]]:
    out = {m.start(): (m.start(), m.end(), "@") for m in _SPACED.finditer(text)}
    last = 0
    for m in _WORDED.finditer(text):
        host = m["host"].lower()
        if m["at"] and (m["name"].lower() in _BEFORE_ADDRESS and not _DOT.search(host) or host.startswith("www.")):
            continue
        sign = "at" if m["at"] else "sign"
        if m[sign] != "@":
            out[m.start(sign)] = (*m.span(sign), "@")
        out |= {d.start(): (d.start(), d.end(), ".") for d in _DOT.finditer(text, *m.span("host"))}
        # The name may go on to the left: "jane dot doe at".
        lo = m.start("name")
        while part := _NAME_PART.search(text[max(last, lo - 90): lo]):
            if part["part"].lower() in DETERMINERS:
                break
            base = max(last, lo - 90)
            out[base + part.start("sign")] = (base + part.start("sign"), lo, NAME_WORDS[part["word"].lower()])
            lo = base + part.start()
        last = m.end()
    return [out[k] for k in sorted(out)]


def _parted(text: str) -> list[tuple[int, int, str]]:
    out = {}
    for m in _PARTED.finditer(text):
        if m.start("host") - m.start() > 1:
            out[m.start()] = (m.start(), m.start("host"), "@")
        out |= {d.start(): (d.start(), d.end(), ".") for d in _PARTED_DOT.finditer(text, *m.span("host"))}
    for m in _SPACED_IP.finditer(text):
        out |= {d.start(): (d.start(), d.end(), ".") for d in _PARTED_DOT.finditer(text, *m.span())}
    out |= {m.start("dot"): (*m.span("dot"), ".") for m in _BETWEEN.finditer(text)}
    return [out[k] for k in sorted(out)]


TRANSDUCERS = (_references, _characters, _letters, _signs, _worded, _parted, _plus, _digits)


def normalise(text: str) -> Mapped:
    """``text`` through all transducers, with the way back to its characters."""
    mapped = Mapped(text)
    for transducer in TRANSDUCERS:
        mapped = mapped.rewrite(transducer(mapped.text))
    return mapped


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the text itself, and all spans: those and the hidden ones that are longer than each
    of them of the same kind that they overlap."""
    base = detect(text)
    if not _may_hide(text):
        return base, base
    mapped = normalise(text)
    more = [(kind, mapped.start(lo), mapped.end(hi)) for kind, lo, hi in detect(mapped.text)]
    # The base spans of a kind do not overlap, so those that a hidden one meets are neighbours.
    plain = {kind: [(s, e) for k, s, e in base if k == kind] for kind in KINDS}

    def open_one(kind: str, lo: int, hi: int) -> bool:
        near = plain[kind]
        at = bisect_right(near, lo, key=lambda span: span[1])
        while at < len(near) and near[at][0] < hi:
            if hi - lo <= near[at][1] - near[at][0]:
                return True
            at += 1
        return False

    more = [span for span in more if not open_one(*span)]
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``base`` (spans of the text itself) and ``spans`` (with the hidden ones)
    for every row of ``documents``; other columns are ignored.

    Spans are code points of the source, end exclusive, by kind (email, ip, card, phone) and
    start. A hidden span may hold a shorter one of the text itself. A null or empty text has none. Repeated rows stay repeated.
    """
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(found: list[list[tuple[str, int, int]]]) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f] for f in found], spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [find(t or "") for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["text"], rows([b for b, _ in found]), rows([x for _, x in found])],
                                                 names=["doc_id", "text", "base", "spans"])

    kept = documents.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, text string, base {_SPANS}, spans {_SPANS}")


def masked(documents: DataFrame) -> DataFrame:
    """``documents`` with each span of ``text`` replaced by its kind in brackets; overlapping
    spans are one, named by the first. Other columns, and texts without spans, stay."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else mask(t, find(t)[1]) for t in texts], dtype=object)

    return documents.withColumn("text", F.pandas_udf(run, "string")("text"))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at, open_end = [], 0, 0
    for kind, lo, hi in sorted(spans, key=lambda s: (s[1], -s[2])):
        if lo >= open_end:
            out += [text[at:lo], f"[{kind}]"]
        open_end = at = max(open_end, hi)
    return "".join([*out, text[at:]])


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of a column of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
