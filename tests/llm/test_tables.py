from __future__ import annotations

import gzip
import html
import os
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import rows
from pyspark.sql import functions as F

from auditloom.llm import sharding, template, topk, warc
from auditloom.llm.common import scratch, table


def brute_top(vectors, k, every):
    data = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in data:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in data if i != q and len(w) == len(v))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_top_matches_brute_force(spark, scale, monkeypatch):
    rng = np.random.default_rng(2)
    data = [(i, [float(np.float32(x)) for x in rng.normal(0, scale, 40)]) for i in range(300)]
    data += [(1000 + i, data[7][1]) for i in range(30)] + [(None, data[0][1]), (400, None), (401, []), (500, [float("nan")] * 40), (501, [None] * 40),
             (502, [float("inf")] + [0.0] * 39), (600, [1.0, 2.0]), (601, [1.0, 1.0])]
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "HELD", 1600)
    frame = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id bigint, embedding array<float>, rank int")
    got = {tuple(r) for r in topk.nearest(frame, k=10, every=100).collect()}
    assert got == brute_top(data, 10, 100)
    assert topk.nearest(frame.where("false")).count() == 0
    clashing = frame.withColumn("dims", F.lit("x")).withColumn("v", F.lit(2)).withColumn("query_ids", F.lit(None))
    assert {tuple(r) for r in topk.nearest(clashing, k=10, every=100).collect()} == got


def test_a_floor_of_earlier_blocks_loses_no_tie():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 4, (500, 32)).astype(float)
    ids, query = rng.permutation(500), rng.integers(-3, 4, 32).astype(float)
    found = None
    for i in range(0, 500, 60):
        found = topk.Block(ids[i: i + 60], vectors[i: i + 60]).top(-1, query, 10, found)
    want = sorted(zip((-(vectors @ query)).tolist(), ids.tolist()))[:10]
    assert list(zip((-found[1]).tolist(), found[0].tolist())) == want


def test_permutation_is_a_bijection_both_ways():
    for n in (0, 1, 2, 3, 10, 97, 1000, 4097):
        p = sharding.Permutation(n, seed=3)
        there = p.forward(np.arange(n))
        assert sorted(there.tolist()) == list(range(n)) and (p.backward(there) == np.arange(n)).all()
    big = sharding.Permutation(10**15)
    x = np.arange(0, 10**15, 10**12)
    assert (big.backward(big.forward(x)) == x).all() and big.forward(x).max() < 10**15


def test_shards_are_even_gapless_and_reproducible(spark):
    data = rows.DOCUMENTS + [(100 + k, rows.BASE) for k in range(80)]
    one = sharding.shards(rows.documents(spark, data), 7).collect()
    two = sharding.shards(rows.documents(spark, data[::-1]).repartition(5), 7).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["slot"])
    assert sorted(map(key, one)) == sorted(map(key, two)) and len(one) == len(data)
    slots = [sorted(r["slot"] for r in one if r["shard"] == s) for s in range(7)]
    assert all(s == list(range(len(s))) for s in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1
    for r in one:
        assert sharding.row_at(r["shard"], r["slot"], len(one), 7) == r["row_number"]
    sizes = {(r["doc_id"], r["size"], r["text_crc32"]) for r in one}
    assert sizes == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in data}
    assert sharding.shards(rows.documents(spark, [])).count() == 0


def placement_sql(n: int, count: int, seed: int = 0) -> str:
    """The permutation of 0 .. n - 1 in SQL, walking up to four times."""
    p = sharding.Permutation(n, seed)
    last, steps = "start", [f"start AS (SELECT range AS i, range AS p FROM range({n}))"]
    for walk in range(4):
        steps.append(f"w{walk} AS (SELECT *, p // {p.right} AS l, p % {p.right} AS r FROM {last})")
        last = f"w{walk}"
        for k, key in enumerate(p.keys):
            own, other, size = ("l", "r", p.left) if k % 2 == 0 else ("r", "l", p.right)
            mixes = [f"({other} + {key}) % 4294967296", "(xor(m, m >> 15) * 2246822507) % 4294967296", "(xor(m, m >> 13) * 3266489909) % 4294967296", "xor(m, m >> 16)"]
            for j, mix in enumerate(mixes):
                steps.append(f"m{walk}_{k}_{j} AS (SELECT * {'EXCLUDE (m)' if j else ''}, CAST({mix.replace('xor(m, m', 'xor(m, m')} AS HUGEINT) AS m FROM {last})")
                last = f"m{walk}_{k}_{j}"
            steps.append(f"f{walk}_{k} AS (SELECT * EXCLUDE (m) REPLACE (({own} + m % {size}) % {size} AS {own}) FROM {last})")
            last = f"f{walk}_{k}"
        steps.append(f"e{walk} AS (SELECT i, CASE WHEN p < {n} AND {walk} > 0 THEN p ELSE l * {p.right} + r END AS p FROM {last})")
        last = f"e{walk}"
    return f"WITH {', '.join(steps)} SELECT CAST(i AS BIGINT), CAST(p % {count} AS BIGINT), CAST(p // {count} AS BIGINT) FROM {last} ORDER BY i"


def test_places_match_sql():
    n = 500
    places = sharding.Permutation(n).forward(np.arange(n))
    assert duckdb.sql(placement_sql(n, 24)).fetchall() == [(i, p % 24, p // 24) for i, p in enumerate(places.tolist())]


PAGES = [(1, "http://a.org/x", "<p>one</p>"), (2, "http://a.org/y?q=1", "<p>one</p>"), (3, None, "<p>two</p>"), (4, "", None), (5, "http://[bad", ""),
         (6, "http://B.a.org:80/ z\r\n", "<p>one</p>"), (6, "http://a.org/x", "<p>one</p>"), (None, "http://a.org/x", "<p>one</p>"), (7, "http://a.org/x", "x\r\n\r\ny\x00"),
         (-3, "http://n.org/", "<p>é</p>"), (9, "http://n.org/long", "lorem " * 100000)]


def test_archives_give_back_every_page(spark):
    frame = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id bigint, url string, html string, digest string").repartition(3)
    got = sorted(map(tuple, warc.captures(frame).collect()), key=str)
    first = {}
    for i, _, text in PAGES:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    want = []
    for i, _, text in PAGES:
        data = (text or "").encode()
        origin = first.get(text or "") if i is not None and first[text or ""] < i else None
        want.append((i, len(data), warc.payload_digest(data), "response" if origin is None else "revisit", origin))
    assert got == sorted(want, key=str)
    assert warc.captures(frame.where("false")).count() == 0


def test_small_payloads_are_all_responses(spark):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string")
    assert {r["page_id"]: r["record_type"] for r in warc.captures(frame, least_bytes=3).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_every_capture_is_found_through_the_index(spark, monkeypatch):
    """Neighbours are read in one range, a block once, and copies of one text once a task."""
    data = [(i, f"http://h{i % 3}.org/{i // 3:04d}", f"page {i} " * 20) for i in range(600)] + [(1000 + i, f"http://c.org/{i}", "the same") for i in range(400)]
    frame = spark.createDataFrame(data, "page_id bigint, url string, html string")
    folder, index = scratch(spark, "test-warc"), scratch(spark, "test-index")
    warc.write_archives(frame.coalesce(1), folder)
    rows = warc.read_archives(spark, folder)
    assert rows.where("payload_key IS NULL").count() == 0 and rows.select("payload_key").distinct().count() == 601
    directory = warc.write_index(rows.coalesce(1), index).collect()
    assert sum(1 for _ in directory) >= 4
    asked = sorted({r["payload_key"] for r in rows.collect()} | {"zz,none)/ 1 "})
    stream = sorted([(r["first_key"], 0, None, r["path"], r["offset"], r["length"]) for r in directory] + [(k, 1, 0, None, None, None) for k in asked], key=lambda x: x[:2])
    batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in stream], t) for k, t in ((0, pa.string()), (2, pa.int32()), (3, pa.string()), (4, pa.int64()), (5, pa.int64()))],
                                       names=["key", "salt", "path", "offset", "length"])
    reads, plain = [], warc.read_range
    monkeypatch.setattr(warc, "read_range", lambda *place: reads.append(place[0]) or plain(*place))
    found = {k: (n, d) for b in warc._sweep(iter([batch])) for k, n, d in zip(*(b[c].to_pylist() for c in ("payload_key", "payload_bytes", "payload_digest")))}
    assert len(found) == 601 and set(asked) - set(found) == {"zz,none)/ 1 "}
    opened = sum(index in r for r in reads)
    assert opened <= len(directory) and len(reads) - opened < 60
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in warc.captures(frame).collect()}
    assert got == {i: (len(h), warc.payload_digest(h.encode()), 1000 if i > 1000 else None) for i, _, h in data}


def test_captures_of_one_id_and_url_keep_their_payloads(spark):
    data = [(1, "u", "a"), (1, "u", "bb"), (2, "u", "a"), (3, "u", "bb"), (1, "u", "a")]
    got = [(r["page_id"], r["payload_bytes"], r["refers_to"]) for r in warc.captures(spark.createDataFrame(data, "page_id bigint, url string, html string")).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, None), (1, 1, None), (1, 2, None), (2, 1, 1), (3, 2, 1)], key=str)


def test_archives_are_gzip_members_that_ranges_open(spark):
    folder = scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"), folder)
    for r in warc.read_archives(spark, folder).collect():
        data = warc.read_range(r["path"], r["offset"], r["length"])
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n") and len(list(warc.members(data))) == 1


def test_members_of_any_size():
    big = os.urandom(1 << 20) * 17
    data = b"".join(warc.member(x) + b"\0" for x in (b"a", big, b"b"))
    assert [c for _, _, c in warc.members(data)] == [b"a", big, b"b"]


def test_keys_reverse_the_host():
    assert warc.surt("https://WWW.Example.org:8080/a/b?c=d#e") == "org,example,www:8080)/a/b?c=d"
    assert warc.surt("nonsense") == "nonsense" and warc.capture_key("http://a.b/", -1) < warc.capture_key("http://a.b/", 0) < warc.capture_key("http://a.b/", 10)


def test_text_of_given_pages(spark, folder):
    pages = table(spark, folder, "pages")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?(?:b|br)>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in template.main_text(pages).collect()} == want


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("a < b", "a < b"), ("<div>x<br>y</div>", "x y"),
    ("<article><h1>T&eacute;</h1><header><h2>H</h2><span>by</span></header><p>1  <i>2</i></p><div class='ad box'>buy</div><ul><li>x<li>y</ul>"
     "<section id=comments><p>c</p></section></article><p>after</p>", "Té\nH\n1 2\nx\ny"),
    ("<nav>n</nav><main><p>m</p></main><aside>s</aside><footer>f</footer>", "m"), ("<script>var x='<p>';</script><p>k</p><style>p{}</style><!-- c -->", "k"),
    ("<p hidden>h</p><p style='display: none'>d</p><div role=navigation>r</div><p>v", "v"), ("<p>open <b>bold", "open bold"), ("<p title=\"a>b\">q</p>", "q")])
def test_text_of_a_page(source, text):
    assert template.Page(source).text() == text


def test_what_a_host_repeats_is_removed(spark):
    def page(i, shared):
        return f"<div class=x1><span>Our shop since 1900</span></div><div><p>Story {i}</p>{'<p>Same line</p>' if shared else ''}</div>"

    pages = [(i, f"http://h.org/{i}", page(i, i < 4), "t") for i in range(10)] + [(100 + i, f"http://g.org/{i}", page(i, False), "t") for i in range(3)]
    pages += [(200 + i, f"http://k.org/{i}", f"<article><p>Story {i}</p><p>Motto</p></article>", "t") for i in range(8)] + [(300, None, None, "t")]
    got = {r["page_id"]: r["text"] for r in template.main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")).collect()}
    assert got[0] == "Story 0\nSame line" and got[9] == "Story 9"
    assert got[100] == "Our shop since 1900\nStory 0" and got[200] == "Story 0\nMotto" and got[300] == ""
    assert template.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def texts_of(spark, pages):
    return {r["page_id"]: r["text"] for r in template.main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}


def test_what_a_host_repeats_inside_articles_is_removed(spark):
    def page(i):
        return (f"<article><h1>Title {i}</h1><div class=x1>Get our letter <b>every day</b></div><section><p>Story {i}</p><p>Motto</p></section>"
                f"<table><tr><th>Name</th><th>Age</th></tr><tr><td>n{i}</td><td>0</td></tr></table><div>In <i>{'Rome' if i else 'Bonn'}</i> on day {i}</div></article>")

    got = texts_of(spark, [(i, f"http://h.org/{i}", page(i)) for i in range(8)])
    assert got == {i: f"Title {i}\nStory {i}\nMotto\nName\nAge\nn{i}\n0\nIn {'Rome' if i else 'Bonn'} on day {i}" for i in range(8)}


def test_copies_of_a_page_keep_their_text(spark):
    whole = "<html><body><div id=page><article><h1>T</h1><div><p>Long story</p></div></article></div></body></html>"
    plain = "<html><body><div><p>First part</p><p>Second part</p></div></body></html>"
    parts = "<div>First half of it</div><div>Other half of it</div>"
    pages = [(i, f"http://h.org/{i}", whole) for i in range(8)] + [(10 + i, None, plain) for i in range(8)] + [(20 + i, f"http://p.org/{i}", parts) for i in range(8)]
    pages += [(30 + i, f"http://n.org/{i}", f"<nav>{i}</nav>{parts}") for i in range(8)] + [(50 + i, f"http://p.org/x{i}", f"<div>First half of it</div>Story {i}") for i in range(9)]
    pages += [(40 + i, f"http://w.org/{i}", f"<body><div class=w>Our shop</div><main><div>Same words</div><div>Story {i}</div></main></body>") for i in range(8)]
    got = texts_of(spark, pages)
    assert [got[k] for k in (0, 10, 20, 30, 40, 50)] == ["T\nLong story", "First part\nSecond part", "Other half of it", "First half of it\nOther half of it", "Story 0", "Story 0"]


@pytest.mark.parametrize("source, text", [
    ("<html class='cookie-ok'><body class='no-sidebar'><p>a</p></body></html>", "a"), ("<body class=menu><div class=menu>n</div><p>a</p>", "a"),
    ("<div id='page' class='has-menu'><article><p>a</p></article></div>", "a"), ("<article class='post comments-open'><p>a</p><div class='share'>s</div></article>", "a"),
    ("<main class='widget'><p>a</p></main><p>b</p>", "a"), ("<div role=main class='social'><p>a</p></div>", "a"), ("<div class='sidebar'><article>a</article></div>", "a"),
    ("<article>a</article><div id=comments><article class=comment>c</article></div>", "a"), ("<main><p>a</p><div class=related><article>r</article></div></main>", "a"),
    ("<div class=comments><main>a</main></div>", "a"), ("<div class='popup'><aside><article>x</article></aside>y</div><p>a</p>", "a")])
def test_names_of_what_holds_the_article(source, text):
    assert template.Page(source).text() == text


@pytest.mark.parametrize("source", [
    "<b>x" * 20000, "<a " * 20000, "<b>x" * 10000 + "</u>" * 20000, "<div>x" * 20000, '<a ">" ' * 20000, "<script " * 20000, "<script>" + "</script" * 20000,
    "<!x" * 20000, "<article><header>" + "<i>x" * 20000, "<article><p><table>" + "<div>x" * 20000], ids=lambda s: s[:12])
def test_long_pages_take_linear_time(source):
    began = time.process_time()
    page = template.Page(source)
    page.text(frozenset(list(page.subtrees().values())[:1]))
    assert time.process_time() - began < 5


def test_unclosed_tags_are_text():
    assert template.Page('<p>a</p><b x="1 <i>c</i> <!-- d -->e <u f').text() == 'a\nc e <u f'
    assert template.Page("a <b c <!-- d").text() == "a <b c"


def test_blocks_of_a_section_are_removed_from_large_hosts(spark):
    def page(i):
        return f"<div><a>Goods {i % 3}</a> <a>Prices and terms</a></div><div><p>Story {i}</p>{'<p>Thanks</p>' if i < 6 else ''}<div>Read</div></div>"

    pages = [(i, f"http://h.org/{i}", page(i)) for i in range(30)] + [(100 + i, f"http://h.org/x{i}", f"<p>Other {i}</p>") for i in range(200)]
    got = texts_of(spark, pages)
    assert [got[i] for i in range(30)] == [f"Story {i}" + ("\nThanks" if i < 6 else "") for i in range(30)] and got[100] == "Other 0"
