"""Main text of web pages, with what a site repeats on its pages removed.

One pass hashes the element subtrees of every page; Spark counts them per host; subtrees that
recur on several different pages of their host are its template. A second pass leaves out the template,
and what names itself as something else than the article: menus, headers, footers, side bars,
notices, adverts, forms, scripts, comments.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from auditloom.llm.common import durable, stored
from auditloom.llm.words import slices

#: A subtree is template if this many of the host's pages of different text hold it.
PAGES = 5
#: Prose, inline elements and blocks of fewer than WORDS words may recur by chance or quotation: those
#: are template if also this share of the host's pages of different text holds them.
SHARE = 0.05
WORDS = 3

# ``open``: the text ended inside a tag, which then is none.
_TAGS = r"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|textarea|title|noscript|template|iframe|xmp)\b[^>]*>.*?(?:</(?P=raw)[^>]*(?:>|\Z)|\Z)
    |<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>{attrs})(?:>|(?P<open>\Z))
    |<[!?][^>]*(?:>|(?P<open_mark>\Z))"""
_TOKEN = re.compile(_TAGS.format(attrs="""(?:"[^"<]*"|'[^'<]*'|[^>])*+"""), re.S | re.I | re.X)
_PLAIN_TOKEN = re.compile(_TAGS.format(attrs="[^>]*+"), re.S | re.I | re.X)
_ATTR = re.compile(r"""([a-z][a-z0-9-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
#: Parts of a table or list that, in an article, go with the whole only.
PARTS = frozenset("tr thead tbody tfoot caption colgroup summary legend hgroup".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag that ends an open element of these.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div body".split())
#: Elements that are never article text.
OTHER_TAGS = frozenset("""nav aside footer form button select option input textarea label menu dialog object canvas svg audio video map head
applet frameset noframes datalist output progress""".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words in class or id that say the same.
OTHER_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice
newsletter subscribe subscription social share sharing sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments
disqus respond reply replies related recommended popup modal overlay widget pagination pager toolbar login signup paywall skip""".split())
#: Classes or ids, in full, of blocks whose articles are not the page's.
OTHER_LISTS = frozenset("comment comments disqus respond reply replies related recommended sidebar".split())


def _tokens(source: str) -> Iterator[re.Match]:
    """Tags and comments of ``source``, in linear time.

    After a tag that the text ends in, quotes are no longer heeded and tags are sought up to the last ``>`` only, so each
    of many unclosed tags does not search the rest of the text.
    """
    at, end = 0, len(source)
    for pattern in (_TOKEN, _PLAIN_TOKEN):
        for m in pattern.finditer(source, at, end):
            if m["open"] is not None or m["open_mark"] is not None:
                at, end = m.start() + 1, max(source.rfind(">"), m.start()) + 1
                break
            yield m
        else:
            break
    comment = source.find("<!--", end)
    if comment >= 0:
        yield _TOKEN.match(source, comment)


class Page:
    """Elements of a page in document order, and its text as runs between block borders."""

    def __init__(self, source: str):
        self.tag, self.parent, self.other = ["#page"], [0], [False]
        self._role, self._names = [""], [""]
        self.main: set[int] = set()
        self.runs: list[tuple[int, str]] = []  # (element, text); (element, "") is a block border
        # Of each element: the header around it, whether a heading is between, whether an article or main element is around it.
        self._header, self._headed, self._within = [0], [False], [False]
        stack, at = [0], 0
        places: dict[str, list[int]] = {}  # of each tag, where it is open in the stack
        scopes: list[int] = []

        def cut(k: int) -> None:
            for node in stack[k:]:
                places[self.tag[node]].pop()
                if self.tag[node] in SCOPE:
                    scopes.pop()
            del stack[k:]

        for m in _tokens(source):
            if m.start() > at:
                self.runs.append((stack[-1], source[at: m.start()]))
            at = m.end()
            tag = m["tag"]
            if not tag:
                continue
            tag = tag.lower()
            if tag in BLOCK:
                self.runs.append((stack[-1], ""))
            elif tag == "br":
                self.runs.append((stack[-1], " "))
            if m["close"]:
                if places.get(tag):
                    cut(places[tag][-1])
                continue
            if tag in VOID:
                continue
            ended = max((places[t][-1] for t in ENDS.get(tag, ("p",) if tag in BLOCK else ()) if places.get(t)), default=0)
            if ended and (not scopes or ended >= scopes[-1]):
                cut(ended)
            places.setdefault(tag, []).append(len(stack))
            if tag in SCOPE:
                scopes.append(len(stack))
            stack.append(self._open(stack[-1], tag, m["attrs"]))
        if at < len(source):
            self.runs.append((stack[-1], source[at:]))
        self._apply_names()

    def _open(self, parent: int, tag: str, attrs: str) -> int:
        other, role, names = tag in OTHER_TAGS, "", ""
        if attrs and not attrs.isspace():
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("class", "id"):
                    names += " " + value
                elif name == "role":
                    role = value
                    other = other or value in OTHER_ROLES
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                    other = True
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self._role.append(role)
        self._names.append(names)
        self.other.append(other or self.other[parent])
        self._header.append(node if tag == "header" else self._header[parent])
        self._headed.append(tag in HEADING or tag != "header" and self._headed[parent])
        self._within.append(tag in ("article", "main") or self._within[parent])
        return node

    def _apply_names(self) -> None:
        """Marks the blocks whose class or id says that they are not the article, and finds the
        article and main elements.

        A name on html, body, an article or main element or what holds one says something of
        the page ("no-sidebar"), so it marks nothing there, unless it is in full that of a list
        of other articles and the page has others.
        """
        kind = [tag if tag in ("article", "main") else role if role in ("article", "main") else "" for tag, role in zip(self.tag, self._role)]
        around = [""] * len(self.tag)  # the greater of what it is and holds; "main" > "article"
        for node in range(len(self.tag) - 1, 0, -1):
            if not self.other[node]:
                around[node] = max(around[node], kind[node])
                around[self.parent[node]] = max(around[self.parent[node]], around[node])
        plain = self.other
        for lists in (OTHER_LISTS, frozenset()):
            self.other = plain[:]
            for node in range(1, len(self.tag)):
                other = self.other[node] or self.other[self.parent[node]]
                if not other and self._names[node] and self.tag[node] not in ("html", "body"):
                    if not around[node]:
                        other = not OTHER_NAMES.isdisjoint(_NAME.findall(self._names[node]))
                    elif around[node] == "article" and not kind[node]:
                        other = not lists.isdisjoint(self._names[node].split())
                self.other[node] = other
            self.main = {n for n in range(1, len(self.tag)) if kind[n] and not self.other[n]}
            if any(text and not text.isspace() for _, text in self._kept()):
                break

    def inside(self, tops: set[int]) -> list[bool]:
        """For each element, whether it is one of ``tops`` or in one."""
        out = [False] * len(self.tag)
        for node in range(len(self.tag)):
            out[node] = node in tops or bool(node) and out[self.parent[node]]
        return out

    def _kept(self) -> list[tuple[int, str]]:
        """The runs of all article elements, else of the main part, else of the page, and block borders."""
        articles = {n for n in self.main if self.tag[n] == "article"} or self.main
        main = self.inside(articles) if articles else None
        return [(node, text) for node, text in self.runs
                if not text or not self.other[node] and (main is None or main[node]) and not self._page_header(node)]

    def subtrees(self) -> dict[int, int]:
        """Hash of the tags and kept text of each element that may be template: no prose of an
        article or main part, no part of a sentence, and not what holds an article, a main part
        or all text of the page. The hash is odd where the subtree needs a share of the pages."""
        main = self.inside(self.main)
        parts: list[list[str]] = [[] for _ in self.tag]
        worded, holds, size, words = [False] * len(self.tag), [False] * len(self.tag), [0] * len(self.tag), [0] * len(self.tag)
        for node, text in self._kept():
            text = _SPACE.sub(" ", text).strip()
            if text:
                parts[node].append(text)
                size[node] += len(text)
                found = len(_WORD.findall(text))
                words[node] += found
                worded[node] = worded[node] or found > 0
        for node in range(len(self.tag) - 1, 0, -1):
            size[self.parent[node]] += size[node]
            words[self.parent[node]] += words[node]
            holds[node] = holds[node] or node in self.main
            holds[self.parent[node]] = holds[self.parent[node]] or holds[node]
        prose, in_sentence = self._prose(), self._in_sentence(worded)
        out: dict[int, int] = {}
        for node in range(len(self.tag) - 1, 0, -1):
            if parts[node]:
                digest = hashlib.blake2b("\x1f".join([self.tag[node], *parts[node]]).encode("utf-8", "surrogatepass"), digest_size=8).digest()
                parts[self.parent[node]].append(digest.hex())
                if (not holds[node] and self.tag[node] not in ("html", "body") and size[node] < size[0]
                        and not (main[node] and (prose[node] or node in self.main)) and not in_sentence[node]):
                    loose = words[node] < WORDS or self.tag[node] in PROSE or self.tag[node] in PARTS or self.tag[node] not in BLOCK
                    out[node] = int.from_bytes(digest, "big", signed=True) & ~1 | loose
        return out

    def _prose(self) -> list[bool]:
        """Whether each element is prose or in prose, below the article or main element around it."""
        out = [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            out[node] = node not in self.main and (self.tag[node] in PROSE or self.tag[node] in PARTS or out[self.parent[node]])
        return out

    def _in_sentence(self, worded: list[bool]) -> list[bool]:
        """Whether each element is inline and stands among words of its block."""
        out = [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            out[node] = self.tag[node] not in BLOCK and (worded[self.parent[node]] or out[self.parent[node]])
        return out

    def text(self, template: frozenset[int] = frozenset()) -> str:
        """Blocks of the article, joined by line feeds: of all article elements, else of the main
        part, else of the page. A page of nothing but template keeps its text."""
        left_out = self.inside({n for n, h in self.subtrees().items() if h in template}) if template else None
        blocks, block = [], []
        for node, text in [*self._kept(), (0, "")]:
            if text:
                if not (left_out and left_out[node]):
                    block.append(text)
            elif block:
                made = _SPACE.sub(" ", entities.unescape("".join(block))).strip()
                if made:
                    blocks.append(made)
                block = []
        return "\n".join(blocks) if blocks or not template else self.text()

    def _page_header(self, node: int) -> bool:
        """Whether text is in a header element, but not in a heading there inside an article."""
        header = self._header[node]
        return bool(header) and not (self._headed[node] and self._within[header])


def _hash_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            pages = [Page(h or "") for h in part["html"].to_pylist()]
            contents = [int.from_bytes(hashlib.blake2b(p.text().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) for p in pages]
            found = [list(set(p.subtrees().values())) for p in pages]
            yield pa.RecordBatch.from_arrays([part["host"], part["source"], pa.array(contents, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             names=["host", "source", "content", "subtrees"])


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            texts = [Page(h or "").text(frozenset(t or ())) for h, t in zip(part["html"].to_pylist(), part["template"].to_pylist())]
            yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def host_of(url: str):
    """Lower-case host of a URL column; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _source() -> Column:
    """What tells the html of one page from that of another."""
    return F.unhex(F.md5(F.coalesce("html", F.lit("")))).alias("source")


def templates(pages: DataFrame, share: float = SHARE, least: int = PAGES) -> DataFrame:
    """Hashes of the subtrees of a page that are template, one row per ``host`` and ``source`` (of
    the html) with any.

    The array of a page has at most its own subtrees, however many pages its host has.
    """
    seen = stored(pages.select(host_of("url").alias("host"), "html", _source())
                  .mapInArrow(_hash_pages, "host string, source binary, content bigint, subtrees array<bigint>"), "subtrees")
    # Pages of equal text count once. The null subtree stands for the page itself.
    counted = durable(seen.select("host", "content", F.explode(F.concat("subtrees", F.array(F.lit(None).cast("bigint")))).alias("subtree"))
               .groupBy("host", "subtree").agg(F.count_distinct("content").alias("n")).where((F.col("n") >= least) | F.col("subtree").isNull()))
    totals = counted.where("subtree IS NULL").select("host", F.col("n").alias("total"))
    many = (counted.where("subtree IS NOT NULL").join(totals, "host")
            .where((F.col("subtree") % 2 == 0) | (F.col("n") >= share * F.col("total"))).select("host", "subtree"))
    return (seen.select("host", "source", F.explode("subtrees").alias("subtree")).join(many, ["host", "subtree"])
            .groupBy("host", "source").agg(F.collect_set("subtree").alias("template")))


def main_text(pages: DataFrame, share: float = SHARE, least: int = PAGES) -> DataFrame:
    """``page_id``, ``url`` and ``text`` (main text) of every row of ``pages`` (``page_id``, ``url``,
    ``html``); other columns are ignored.

    A null or empty html gives an empty text. A null url, or one without a host, counts with the
    other such pages as one host. Repeated rows stay repeated and agree.
    """
    source = pages.select("page_id", "url", "html", host_of("url").alias("host"), _source())
    kind = dict(pages.dtypes)
    return (source.join(templates(pages, share, least), ["host", "source"], "left").select("page_id", "url", "html", "template")
            .mapInArrow(_read_pages, f"page_id {kind['page_id']}, url {kind['url']}, text string"))
