"""The training-data operators against brute-force versions, exact round trips and held-out accuracy on small tables."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import subprocess
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from freshet.llm import bpe, decontaminate, html_text, licenses, line_dedup, media, quality, simhash, token_files, warc
from freshet.llm.common import scratch_dir
from freshet.llm.pieces import PieceIds, byte_slices

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
LONG = "the quick brown fox " * 6000
TEXTS = ["", None, " \n\t ", "one", "Two words", "the cat sat on the mat " * 4, "the cat sat on the mat " * 4, "ÉCOLE naïve 中文 😀 <|endoftext|> 123", "x" * 700, LONG, "a\x1cb\x85c　d", "It's we're 'S  \n\n end "]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src", 1) for i, t in enumerate(TEXTS)] + [(None, "without id", None, None, None), (5, TEXTS[5], None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in ("fp", "score", "ids", "html", "digest", "media", "row", "lines")}).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r[0], []).append(tuple(r)[1:])
    return out


# --- media -----------------------------------------------------------------------------------------------------


def test_media_round_trip(docs, nothing):
    got = by_id(media.round_trip(docs))
    assert sum(map(len, got.values())) == len(TEXTS) + 2 and len(got[5]) == 2
    for i, text in enumerate(TEXTS):
        raw = (text or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        stored = media.to_image(payload)
        assert got[i][0][:6] == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest())
        assert media.from_image(stored) == payload
    assert got[5][0][:8] == got[6][0][:8] and got[0][0][:8] == got[1][0][:8] and got[6][0][7:] == (1, "document 6")
    assert media.round_trip(nothing).count() == 0


def test_unclosed_and_nested_figures():
    seq = media.sequence_of("<figure><img src=a><figure><img src=b><figcaption>inner</figure><img src=c><figcaption>outer <p>two</p></figcaption></figure>after")
    assert [(x["ref"], x["caption"], x["text"]) for x in seq] == [("a", "outer two", None), ("b", "inner", None), ("c", "outer two", None), (None, None, "after")]
    seq = media.sequence_of("<figure><img src=a alt=x><figcaption>never ends <p>more")
    assert [(x["ref"], x["caption"]) for x in seq] == [("a", "never ends more")]
    for tag in ("noscript", "template"):
        assert [x["text"] for x in media.sequence_of(f"<p>one<{tag}>two<p>three")] == ["onetwo", "three"]
        assert [x["text"] for x in media.sequence_of(f"<p>one<{tag}>two</{tag}><p>three")] == ["one", "three"]
    assert [x["text"] for x in media.sequence_of("</figure></figcaption><p>a</p><figcaption>b</figcaption>")] == ["a", "b"]


def test_sequences_of_broken_markup():
    seq = media.sequence_of("<p>1 < 2 &amp; 3<IMG alt='a &quot;b&quot;' SRC=x.png/><!-- <img src=no> --><script>if (a<b) '<img src=no>'</script ><img src=\"y?a=1&amp;b=2\" src=z title=t><img alt=none><style>p{}")
    assert [(x["kind"], x["text"] or x["ref"], x["caption"]) for x in seq] == [("text", "1 < 2 & 3", None), ("media", "x.png/", 'a "b"'), ("media", "y?a=1&b=2", "t")]
    seq = media.sequence_of("<figure><img src=a><figcaption>one</figcaption><img src=b><figcaption>two</figcaption><img src=c alt=own></figure>")
    assert [x["caption"] for x in seq] == ["two", "two", "own"]


@pytest.mark.parametrize("piece", ["<a ", "<!-- ", "<a b='", '<img src="', "<figure><img src=a>", "<figure><figcaption>x", "</figure>", "<script>", "<title>", "< ", "&#", "<p>a<template>"])
def test_sequences_are_linear(piece):
    start = time.perf_counter()
    media.sequence_of("<figure>" + piece * (300_000 // len(piece)))
    assert time.perf_counter() - start < 10


def test_sequences_of_real_pages(spark):
    """All text and references of the given pages are there, in order, and payloads of figures resolve in their places."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = media.sequences(pages, "page_id")
    rows = {r.doc_id: r.sequence for r in found.collect()}
    assert len(rows) == pages.count()
    for page in pages.collect():
        assert [x.pos for x in rows[page.page_id]] == list(range(len(rows[page.page_id])))
        assert [x.ref for x in rows[page.page_id] if x.kind == "media"] == re.findall(r"<(?:img|video|audio|source|embed)\b[^>]*?\bsrc=[\"']?([^\"'\s>]+)", page.html or "")
    stored = media.as_pages(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20))
    whole = media.interleaved(media.sequences(stored), stored.where("media is not null").select("digest", "media").dropDuplicates(["digest"]))
    for r in whole.collect():
        assert [x.kind for x in r.sequence] == ["text", "media"] and r.sequence[1].caption == r.sequence[0].text
        assert hashlib.sha256(media.from_image(bytes(r.sequence[1].media))).hexdigest() == r.sequence[1].ref.removeprefix("sha256:")


def test_damaged_images_are_found():
    stored = bytearray(media.to_image(bytes(range(64))))
    stored[50] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        media.from_image(bytes(stored))


def test_sequences_stay_aligned(spark):
    a, b = "a" * 64, "b" * 64
    html = f'<p>Before</p><figure><img src="sha256:{a}" alt="alt"><figcaption>First <b>one</b></figcaption></figure><p>Between</p><img src="sha256:{b}" alt="second"><img src="http://x/y.png"><script>no</script>After'
    pages = spark.createDataFrame([(1, html), (1, html), (2, None), (3, "<p></p>")], "doc_id long, html string")
    found = media.sequences(pages)
    assert [r.sequence for r in found.where("doc_id > 1").collect()] == [[], []]
    store = spark.createDataFrame([(a, bytearray(b"A"))], "digest string, media binary")
    rows = media.interleaved(found, store).where("doc_id = 1").collect()
    assert len(rows) == 2
    got = [(x.pos, x.kind, x.text, x.caption, bytes(x.media) if x.media is not None else None) for x in rows[0].sequence]
    assert got == [(0, "text", "Before", None, None), (1, "media", None, "First one", b"A"), (2, "text", "Between", None, None), (3, "media", None, "second", None), (4, "media", None, None, None), (5, "text", "After", None, None)]


# --- SimHash ---------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprints(docs):
    for (i, *_), fp in zip([(i,) for i in range(len(TEXTS))], [simhash.fingerprint(t or "") & (2**64 - 1) for t in TEXTS], strict=True):
        if TEXTS[i] != LONG:
            assert fp == brute_fingerprint(TEXTS[i])


def brute_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_links_find_every_pair_up_to_three_bits(spark):
    random.seed(5)
    base = [random.getrandbits(64) for _ in range(40)]
    prints = {}
    for i in range(400):
        fp = random.choice(base)
        for _ in range(random.randint(0, 5)):
            fp ^= 1 << random.choice([random.randrange(64), random.randrange(8)])
        prints[i] = fp
    signed = [(i, fp - 2**64 if fp >> 63 else fp) for i, fp in prints.items()]
    classes = spark.createDataFrame(signed, "doc_id long, fp long").groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = simhash.links(classes).collect()
    from freshet.llm.graph import components

    firsts = {r.fp: r.first_id for r in classes.collect()}
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    least = {}
    for fp, first in firsts.items():
        r = roots.get(fp, fp)
        least[r] = min(least.get(r, first), first)
    assert {i: least[roots.get(fp, fp)] for i, fp in signed} == brute_components(prints)


def test_large_buckets_are_cut_without_loss(monkeypatch):
    rng = np.random.default_rng(2)
    low = np.unique(rng.integers(0, 1 << 12, 900).astype(np.uint64) << np.uint64(3))
    fps = low | np.uint64(7 << 40)
    whole = simhash._spanning(len(fps), *simhash._near(fps, fps, 3, same=True))
    monkeypatch.setattr(simhash, "CUT", 50)
    cut = simhash._spanning(len(fps), *simhash._links(fps, 0, 3))
    assert (whole == cut).all()


def test_least_of_a_hot_key(spark):
    """A star of 3000 nodes, a chain, a lone edge: components as expected, and no key's minimum is lost in its parts."""
    from freshet.llm.graph import components, with_least

    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5040)] + [(9001, 9000)]
    table = spark.createDataFrame(edges, "u long, v long")
    roots = {r.node: r.root for r in components(table).collect()}
    assert roots == {i: 0 for i in range(3000)} | {i: 5000 for i in range(5000, 5041)} | {9000: 9000, 9001: 9000}
    rows = with_least(table, "u", "v", "v").collect()
    assert sorted((r.u, r.v) for r in rows) == sorted(edges)
    assert all(r.least == min(v for u, v in edges if u == r.u) for r in rows if r.u in (0, 5000, 9001))
    nulls = spark.createDataFrame([(1, None, 7), (1, None, 8), (2, None, 7), (2, 5, 9)], "k long, x long, p long")
    assert sorted((r.k, r.p, r.least) for r in with_least(nulls, "k", "x", "p").where("least is not null").collect()) == [(2, 7, 5), (2, 9, 5)]
    assert with_least(nulls, "k", "x", "p").count() == 4 and with_least(nulls.where("k > 9"), "k", "x", "p").count() == 0


def test_components_of_texts(spark, docs, nothing):
    got = by_id(simhash.near_duplicates(docs))
    assert got[5][0][1] == got[6][0][1] == 5 and len(got[5]) == 2
    assert got[0][0] == got[1][0] == got[2][0] == (0, 0)  # no words: fingerprint zero, linked like any other
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").where("doc_id is not null").collect())
    assert ids == [0, 3, 4, 5, 7, 8, 9, 10, 11] and kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_components_against_brute_force(spark):
    random.seed(7)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(25):
        own = [random.choice(words) for _ in range(random.randint(1, 60))]
        for _ in range(random.randint(1, 6)):
            copy = list(own)
            if random.random() < 0.6:
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(" ".join(copy).upper() if random.random() < 0.3 else " ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert got == brute_components({i: brute_fingerprint(t) for i, t in enumerate(texts)})


# --- HTML ------------------------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
<div id="sidebar"><p>side</p></div><div class="cookie-notice">We use cookies</div><article class="post-%d"><h1>Title &amp; more</h1><p>Para <b>one</b><br>next&nbsp;line &am</p>
<ul><li>one<li>two</ul><div class="ad">BUY</div><p>Second <span class="advert">x</span>paragraph<p>a &lt;b&gt; < c<form><p>f</p></form><aside>s</aside><section id="comments"><p>nice!</p></section></article><footer>&copy;</footer><script>if(a<b){"</p>"}</script></body>"""


def test_main_text(spark):
    want = "Title & more\nPara one next line &am\none\ntwo\nSecond paragraph\na <b> < c"
    rows = [(i, "http://www.a.example/x", PAGE % i, "z") for i in range(3)] + [(3, "http://b.example", "", "z"), (4, None, None, "z"), (None, "x", "just text", "z"), (0, "http://www.a.example/x", PAGE % 0, "z"), (6, "http://a.example:80/y", "<body><div class='other'><p>alone here</p></div></body>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string").withColumn("host", F.lit("clash"))
    got = by_id(html_text.extract(pages))
    assert got[0] == [("http://www.a.example/x", want, len(want))] * 2 and got[2][0][1] == want
    assert got[3] == [("http://b.example", "", 0)] and got[4] == [(None, "", 0)] and got[None] == [("x", "just text", 9)]
    assert got[6][0][1] == "alone here"
    assert html_text.extract(pages.limit(0)).count() == 0
    assert {r.host: r.path for r in html_text.winning_paths(pages).collect()}["a.example"] == "html>body>article.post"


def test_an_article_keeps_its_title():
    body = '<div class="wrap"><div class="post"><h1>The title</h1><div class="text"><p>' + "long text here. " * 300 + '</p></div></div><div class="teasers"><a href=x>a link</a></div></div>'
    page = html_text.parse(f"<body>{body}")
    path = html_text.scores(page)[0][0]
    assert path == "body>div.wrap>div.post" and html_text.text_at(page, path).startswith("The title\nlong text")


@pytest.mark.parametrize("wrapper", ['div class="layout has-sidebar"', 'div class="no-sidebar with-nav"', 'div class="elementor-widget-container"', 'div class="sidebar-layout"', 'div class="page no-ads"', 'form id="aspnetForm"', 'div class="post comments"'])
def test_a_wrapper_keeps_the_article_in_it(wrapper):
    tag = wrapper.split()[0]
    inner = "<article><h1>Title</h1><p>The text of the page, and more of it.</p><p>Its end.</p></article><div class='sidebar'><p>side</p></div>"
    for body in (inner, inner.replace("article", "div")):
        page = html_text.parse(f"<body><p>Skip</p><{wrapper}>{body}</{tag}></body>")
        text = html_text.text_at(page, html_text.scores(page)[0][0])
        assert text.endswith("Title\nThe text of the page, and more of it.\nIts end.") and "side" not in page.blocks


def test_marked_boxes_still_go():
    page = html_text.parse("<body><div class='post'><p>A short text of an article.</p></div><div id='comments'><p>" + "A comment. " * 8 + "</p></div><div class='ad'>BUY</div><div hidden><p>no</p></div></body>")
    assert page.blocks == ["A short text of an article."]
    page = html_text.parse("<body><div class='widget'><p>one part</p></div><div class='widget'><p>other part</p></div></body>")
    assert page.blocks == ["one part", "other part"]


def test_an_article_keeps_its_first_and_last_paragraph():
    parts = "<p>The lead.</p><div class='text'>" + "<p>" + "text of a paragraph. " * 20 + "</p>"
    for around, end in (("<div class='content'>", "</div>"), ("", "")):
        page = html_text.parse(f"<body>{around}{parts * 1}" + "<p>More text of the article, which goes on. </p>" * 40 + f"</div><p>The end.</p>{end}</body>")
        text = html_text.text_at(page, html_text.scores(page)[0][0])
        assert text.startswith("The lead.\n") and text.endswith("\nThe end.")


def test_a_page_of_another_template_keeps_its_text():
    one = "<p>" + "A sentence of the article. " * 12 + "</p>"
    page = html_text.parse(f"<body><div class='box'>{one}</div><div class='links'><a href=x>{'link ' * 200}</a></div><div class='story'>{one * 2}</div></body>")
    own = html_text.text_at(page, "body>div.story")
    assert html_text.main_text(page, "body>div.box") == own and html_text.main_text(page, "body>div.story") == own
    assert html_text.main_text(page, None) == own


@pytest.mark.parametrize("tag", ["p title=Bob's", "p title=it's class=x", "p data-x=5\" id=y", "p '", 'p title="'])
def test_a_stray_quote_ends_with_its_tag(tag):
    assert html_text.parse(f"<div><{tag}>first</p><p>second</p></div>").blocks == ["first", "second"]
    assert html_text.parse("<p title='a > b' class = \"c>d\">x</p>").blocks == ["x"]


@pytest.mark.parametrize("html", ["<", "<<<>", "<p", "</p></p>", "<!--", "<script>", "<a href='", "&#0;&#x110000;&", "<table><tr><td>a<td>b<tr><td>c", "<p>" * 3000, "<div>" * 3000 + "x"])
def test_odd_markup(html):
    page = html_text.parse(html)
    assert all(b == " ".join(b.split()) and b for b in page.blocks)


def test_votes_against_brute_force(spark):
    """Winning paths and texts of the given pages, worked out page by page in plain Python."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()] + [(None, None, None), (-1, "http://x/", "<p>only text"), (-1, "http://x/", "")]
    votes = {}
    for _, url, html in rows:
        ranked = [x for x in html_text.scores(html_text.parse(html or "")) if x[1] > 0]
        own = votes.setdefault(html_text.host_of(url), {})
        for path, value in ranked:
            own[path] = own.get(path, 0.0) + value / ranked[0][1]
    winners = {host: max(own, key=lambda p: (round(own[p], 6), -len(p), p)) if own else None for host, own in votes.items()}
    got = sorted(map(str, (tuple(r) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect())))
    wanted = [(i, url, t := html_text.main_text(html_text.parse(html or ""), winners[html_text.host_of(url)]), len(t)) for i, url, html in rows]
    assert got == sorted(map(str, wanted))


def test_deep_pages_take_linear_time():
    for html in ("<div>" * 100_000 + "text", "".join(f"<div class=c{i % 7}>text {i}" for i in range(50_000)), "<form><blockquote>" * 50_000 + "<p>a<li>x" * 9 + "</b></ul>" * 50_000):
        began = time.perf_counter()
        page = html_text.parse(html)
        ranked = html_text.scores(page)
        assert html_text.main_text(page, ranked[0][0] if ranked else None)
        assert time.perf_counter() - began < 30


def test_an_apostrophe_in_a_bare_value():
    page = html_text.parse("<body><article><p title=don't>First words.</p><p>Second ones aren't lost.</p></article></body>")
    assert html_text.main_text(page, None) == "First words.\nSecond ones aren't lost."


# --- licences --------------------------------------------------------------------------------------------------


def test_license_places(spark, docs, nothing):
    texts = ["The Apache License, version 2; apache license. MIT-License!", "gnu generl public license", "mit licens", "the submit license form", "CC BY-NC 4.0", "", None, "apache\nLICENSE é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("labels", F.lit("x"))
    got = by_id(licenses.summary(licenses.scan(df)))
    assert got[0][0][:7] == (9, 3, 1, 7, "apache,mit", "apache,mit", 1.0)
    assert got[1][0][:5] == (4, 0, None, None, "") and got[1][0][5] == "gpl" and 0 < got[1][0][6] < 1
    assert got[2][0][5] == "mit" and got[3][0][5:] == ("", 0.0, "") and got[4][0][:4] == (5, 1, 0, 0)
    assert got[5] == got[6] == [(0, 0, None, None, "", "", 0.0, "")] and got[7][0][:4] == (3, 1, 0, 0)
    assert licenses.scan(docs).count() == len(TEXTS) + 2 and licenses.scan(nothing).count() == 0


def test_spans_are_characters_of_the_text(spark):
    text = "Éa – (BSD  Licence), the\nMIT-license"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(text[x.start : x.end], x.label, x.edits) for x in row.spans] == [("BSD  Licence", "bsd", 1), ("MIT-license", "mit", 0)]
    assert licenses.summary(licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first().spans == f"bsd:{text.index('BSD')}-{text.index('),')}~1,mit:{text.index('MIT')}-{len(text)}~0"


def test_places_in_long_texts_take_linear_time():
    line = " " + "cc by " * 1_700_000
    began = time.perf_counter()
    places = licenses.base_places(line, licenses.BASE)
    assert time.perf_counter() - began < 20 and len(places) == 1_700_000 and places[-1] == (2 * 1_700_000 - 2, "cc-by")


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_every_damaged_notice_is_found():
    random.seed(1)
    search = licenses.NoticeSearch(licenses.NOTICES)
    for notice, label in licenses.NOTICES.items():
        k = licenses.errors_of(notice)
        for _ in range(30):
            text = list(notice)
            for _ in range(random.randint(0, k)):
                at = random.randrange(1, len(text) - 1)
                text[at : at + 1] = random.choice([[], ["q"], ["q", text[at]]])
            text = " ".join("".join(text).split())
            hits = search.find(f" word {text} other ")
            assert any(x == label for *_, x in hits)
            assert all(edit_distance(f" word {text} other "[a:b], min(licenses.NOTICES, key=lambda n: edit_distance(f" word {text} other "[a:b], n))) <= e for a, b, e, _ in hits)


# --- quality ---------------------------------------------------------------------------------------------------


def test_quality(spark, docs, nothing):
    random.seed(4)
    rows, labels = [], []
    for i in range(600):
        good = random.random() < 0.7
        words = [random.choice(["the", "river", "rose", "slowly", "and", "fell", "again"]) + ("" if random.random() < 0.9 else ",") for _ in range(random.randint(20, 200))]
        text = " ".join(words) + "." if good else " ".join(w.upper() + random.choice(["!!", "$$$", " |"]) for w in words)
        rows.append((i, text))
        labels.append((i, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 7)], "doc_id long, quality int").withColumn("x", F.lit(1))
    got = {r.doc_id: r for r in quality.classify(df, marks).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i in range(600) if got[i].held_out] == held
    assert all(got[i].predicted == labels[i][1] for i in held) and all(0 <= r.score <= 1 for r in got.values())
    assert quality.keep_good(df, marks).columns == df.columns
    assert quality.classify(docs, marks).count() == len(TEXTS) + 2 and quality.classify(nothing, marks).count() == 0
    for few in (marks.limit(0), marks.where("quality = 1")):
        assert {r.score for r in quality.classify(docs, few).collect()} == {0.5}


def test_discriminant_against_a_plain_version(spark):
    """Moments that Spark adds up, the cached factors and the scores, against determinants and inverses of all rows at once."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    described = quality.features(docs).cache()
    model = quality.fit(described, labels)
    x_of = {r.doc_id: r.x for r in described.collect()}
    rows = [(x_of[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in x_of and zlib.crc32(str(r.doc_id).encode()) % 5]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    centre, spread = x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), 1e-6))
    z = np.clip((x - centre) / spread, -quality.CLIP, quality.CLIP)
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum((y == k).mean() * own[k] for k in (0, 1))
    pooled = (1 - quality.SHRINK_DIAGONAL) * pooled + quality.SHRINK_DIAGONAL * np.diag(np.diag(pooled)) + 1e-4 * np.eye(len(pooled))
    odds = []
    for k in (0, 1):
        shrunk = (1 - quality.SHRINK) * own[k] + quality.SHRINK * pooled
        away = z - z[y == k].mean(axis=0)
        odds.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(shrunk)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(shrunk), away))
    assert np.allclose(model.log_odds(x), odds[1] - odds[0], rtol=1e-6, atol=1e-6)
    scored = {r.doc_id: r.score for r in quality.score(described, model).collect()}
    plain = 1 / (1 + np.exp(-np.clip(model.slope * (odds[1] - odds[0]) + model.offset, -30, 30)))
    assert np.allclose([scored[r.doc_id] for r in labels.collect() if r.doc_id in x_of and zlib.crc32(str(r.doc_id).encode()) % 5], plain, atol=1e-6)
    held = [(scored[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in scored and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, poor = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum((g > p) + 0.5 * (g == p) for g in good for p in poor) > 0.97 * len(good) * len(poor)


# --- lines -----------------------------------------------------------------------------------------------------


def brute_lines(rows):
    lines = sorted(((d, i, set(w)) for d, t in rows for i, w in enumerate(line_dedup.lines_of(t or "")) if w and d is not None), key=lambda x: x[:2])
    return {(d, i) for n, (d, i, s) in enumerate(lines) if any((a, b) != (d, i) and line_dedup.similar(s, q) for a, b, q in lines[:n])}


@pytest.mark.parametrize("first", [1, 8])
def test_lines_against_brute_force(spark, monkeypatch, first):
    monkeypatch.setattr(line_dedup, "FIRST", first)  # 1: later rounds happen
    random.seed(first)
    words = [f"w{i}" for i in range(50)]
    base = [[random.choice(words) for _ in range(random.randint(1, 90))] for _ in range(12)]
    rows = []
    for d in range(90):
        lines = []
        for _ in range(random.randint(0, 5)):
            own = list(random.choice(base)) if random.random() < 0.7 else [random.choice(words) for _ in range(random.randint(0, 12))]
            for _ in range(random.randint(0, len(own) // 6 + 1)):
                if own:
                    own[random.randrange(len(own))] = random.choice(words)
            lines.append(" ".join(own))
        rows.append((d * 7 % 91, "\n".join(lines)))
    rows += [(200, None), (201, ""), (None, "w1 w2"), (rows[3][0], rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit("clash")).repartition(4)
    gone = line_dedup.removed_lines(df)
    assert {(r.doc_id, r.line) for r in gone.collect()} == brute_lines(rows)
    out = by_id(line_dedup.summary(df, gone))
    assert out[200] == [(1, 0, "")] and sum(map(len, out.values())) == len(rows)


@pytest.mark.parametrize("first", [1, 8])
def test_lines_of_a_word_with_many_rows(spark, monkeypatch, first):
    for name, value in {"FIRST": first, "HELD": 12, "PART": 5, "ROWS": 50}.items():
        monkeypatch.setattr(line_dedup, name, value)
    calls, paired = [], line_dedup.paired_candidates
    monkeypatch.setattr(line_dedup, "paired_candidates", lambda *a: calls.append(a) or paired(*a))
    random.seed(first)
    rows = [(d, "\n".join(f"order {random.randrange(60)} shipped on day {random.randrange(9)} by {random.choice('abcdef')} to {random.randrange(30)}" for _ in range(4))) for d in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    gone = line_dedup.removed_lines(df)
    assert calls and {(r.doc_id, r.line) for r in gone.collect()} == brute_lines(rows)


def test_a_matcher_holds_few_postings_of_a_word(monkeypatch):
    """Words with many postings leave as marks, none of them is compared, even where their packets come piece by piece."""
    sizes, compare = [], line_dedup._Run.__init__

    def watched(self, columns, *rest):
        compare(self, columns, *rest)
        sizes.append(len(self.token))

    monkeypatch.setattr(line_dedup._Run, "__init__", watched)
    monkeypatch.setattr(line_dedup, "HELD", 12)
    rng, packets = np.random.default_rng(1), []
    for k in range(60):
        part = {c: rng.integers(0, 9, 20) for c in line_dedup.POSTING} | {"token": np.where(rng.random(20) < 0.8, 7, rng.integers(100, 400, 20)), "doc": np.arange(20 * k, 20 * k + 20)}
        packets.append([0, 20, *(np.ascontiguousarray(part[c].astype("<u4")).tobytes() for c in line_dedup.POSTING)])
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*packets[i : i + 7], strict=True)], ["bucket", "n", *line_dedup.POSTING]) for i in range(0, 60, 7)]
    out = [r for b in line_dedup._matcher(2, line_dedup.SIMILARITY, 12, 50)(batches) for r in b.to_pylist()]
    assert [r["word"] for r in out if r["doc_id"] is None] == [7]
    assert sizes and max(sizes) < 400 and not any(r["word"] == 7 and r["doc_id"] is not None for r in out)


def test_places_of_words_and_lines(spark):
    """Texts that begin or end with line ends, empty texts and long words keep their lines apart."""
    words = "x" * 40
    rows = [(1, "\n\na b c"), (2, ""), (3, "a b c\n"), (4, "\n"), (5, f"{words} q\nq {words}"), (6, "A  B\tC"), (7, f"{words} q z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.line) for r in line_dedup.removed_lines(df).collect()} == brute_lines(rows) == {(3, 0), (5, 1), (6, 0)}


def test_cleaned_texts(spark, nothing):
    rows = [(1, "a b c\nd e f", 11), (2, "x\nA B C\n\ny", 10), (3, "d e f", 5), (4, None, None), (None, "a b c", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.without_lines(df, line_dedup.removed_lines(df)).collect()}
    assert got == {1: ("a b c\nd e f", 11), 2: ("x\n\ny", 4), 3: ("", 0), 4: (None, None), None: ("a b c", 5)}
    assert line_dedup.removed_lines(nothing).count() == 0


# --- BPE -------------------------------------------------------------------------------------------------------


def test_bpe_against_tiktoken(docs, nothing):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(bpe.digests(bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)))
    for i, text in enumerate(TEXTS):
        ids = reference.encode_ordinary(text or "")
        assert got[i][0] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert len(got[5]) == 2 and bpe.encode(nothing, RANKS, P.PATTERN).count() == 0


ODD_PARTS = ["'s", "'ll", "'S", " ", "  ", "\n", "\t", "a", "Z", "é", "e\u0301", "ß", "中文", "😀", "12", "!", "...", "\x1c", "\x00", "\x85", "\xa0", "\u2003", "\u200b", "　", "the", "\r\n", "_", "२", "Ⅷ", "\u0301", "Σ", "İ", "\u0958", "<|", "<|endoftext|>", "x" * 30, "ab" * 200, "中" * 100, "lorem" * 80]


def odd_texts(n):
    rng = random.Random(9)
    return ["".join(rng.choice(ODD_PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def encoded(coder, texts):
    """The texts' ids by the coder, in slices of a few kilobytes."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    out = []
    for _, raw, offsets in byte_slices([batch.slice(1)], 5000):
        ids, ends = coder.encode(raw, offsets)
        out += [ids[x:y] for x, y in zip(ends, ends[1:], strict=False)]
    return out


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bpe_of_odd_texts(vocabulary):
    ranks = bpe.read_ranks(P.path(vocabulary))
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder, texts = bpe.BytePairEncoder(ranks, P.PATTERN), [None, *odd_texts(600)]
    coder.ids_of = PieceIds(coder.merge, bits=9)  # a table that fills again and again
    for text, ids in zip(texts[1:], encoded(coder, texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text) and coder.decode(ids)[0].tobytes() == text.encode()
    with pytest.raises(ValueError, match="public pattern"):
        bpe.BytePairEncoder(ranks, r"\w+")
    with pytest.raises(ValueError, match="vocabulary lacks"):
        bpe.BytePairEncoder({bytes([b]): 2 * b for b in range(256)}, P.PATTERN).decode(np.array([1]))


def test_bpe_of_long_pieces_by_one_row():
    rng = random.Random(2)
    ranks = bpe.read_ranks(RANKS)
    coder, reference = bpe.encoder(RANKS, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for letters in ("a", "ab", "ACGT", "etaoinshrdlu", "éa", "中ab"):
        text = "".join(rng.choice(letters) for _ in range(3000))
        assert encoded(coder, ["", text])[0].tolist() == reference.encode_ordinary(text)


def test_bpe_where_a_token_is_not_its_own_merge():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abcd": 258, b"aa": 259, b"aab": 260}
    coder, reference = bpe.BytePairEncoder(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    for text in ["abcd", "abcd abcd", "aaaa", "aaab", *("".join(rng.choice("abcd") for _ in range(n)) for n in (5, 40, 300, 900))]:
        assert encoded(coder, ["", text])[0].tolist() == reference.encode_ordinary(text)


# --- decontamination -------------------------------------------------------------------------------------------


def brute_hits(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    own, hit, names = words(text), set(), set()
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            g = w[i : i + 10]
            for j in range(len(own) - len(g) + 1):
                if own[j : j + len(g)] == g:
                    hit.update(range(j, j + len(g)))
                    names.add(str(item))
    return len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("max_words", [10**6, 40])
def test_decontamination_against_brute_force(spark, docs, nothing, max_words):
    random.seed(3)
    words = ["Alpha", "beta", "gamma", "École", "x1"]
    items = [(i, " ".join(random.choice(words) for _ in range(random.randint(1, 16)))) for i in range(2, 12)] + [(20, ""), (21, None), (None, "alpha"), (22, "!! ...")]
    rows = [(i, ", ".join(random.choice(words) for _ in range(random.randint(0, 30)))) for i in range(40)] + [(50, None), (51, ""), (None, "beta"), (3, "again other")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("items", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.summary(decontaminate.scan(df, benchmark, max_words=max_words)))
    known = [(i, t) for i, t in items if i is not None]
    for i, text in rows:
        assert brute_hits(text, known) in got[i]
    spans = decontaminate.scan(df.where("doc_id = 7"), benchmark, max_words=max_words).first()
    text = dict(rows)[7]
    assert [len(re.findall(r"\w+", text[s.start : s.end])) for s in spans.spans] == [r.after - r.first for r in spans.ranges]
    assert decontaminate.scan(nothing, benchmark).count() == 0 and decontaminate.scan(docs, benchmark.limit(0)).where("size(items) > 0").count() == 0


def test_memory_of_a_full_automaton():
    """Windows of as many words as one pass takes fit in some hundred megabytes."""
    code = (
        "import random, resource\n"
        "from freshet.llm import decontaminate as d\n"
        "n = d.MAX_WORDS // d.WINDOW\n"
        "rng = random.Random(1)\n"
        "items = [(str(i), ' '.join(str(rng.randrange(10**9)) for _ in range(1000))) for i in range(n // 1000)]\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "w = d.Windows(items)\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(out.stdout) < 500


def test_contaminated_documents_go(spark):
    passage = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, f"so {passage.upper()}!"), (2, passage[:-4]), (3, None), (None, passage)], "doc_id long, text string")
    kept = decontaminate.without_contaminated(df, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"]


# --- token files -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, docs, nothing, bits, monkeypatch):
    library = Tokenizer.from_file(WORDS)
    rows = token_files.read(token_files.write(docs, scratch_dir(spark), WORDS, bits=bits), with_ids=True).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.start):
        got.setdefault(r.doc_id, []).append(r)
    assert list(got)[0] is None and list(got)[1:] == sorted(i for i in got if i is not None)
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    for i, text in enumerate(TEXTS):
        assert got[i][0].ids == [*library.encode(text or "", add_special_tokens=False).ids, 2]
    assert token_files.round_trip(nothing, WORDS).count() == 0


def test_words_of_odd_texts():
    library, texts = Tokenizer.from_file(WORDS), [None, *odd_texts(600)]
    for public in (True, False):
        coder = token_files.WordEncoder(WORDS)
        assert coder.public  # else this vocabulary isn't what the fixed rules say
        coder.public, coder.ids_of = public, PieceIds(coder.make, bits=9)
        for text, ids in zip(texts[1:], encoded(coder, texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError, match="white space"):
        token_files.WordEncoder(P.path("byte_bpe_50k.json"))


def test_files_are_read_by_many_tasks(spark):
    docs = spark.range(0, 400).selectExpr("id as doc_id", "repeat(concat('word ', id, ' '), 30) as text")
    pages = spark.range(0, 80, 1, 4).selectExpr("id as page_id", "'u' as url", "repeat(concat('x', id), 2000) as html")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")  # several files of small tables
    try:
        manifest, index = token_files.write(docs, scratch_dir(spark), WORDS), warc.write(pages, scratch_dir(spark))
    finally:
        spark.conf.unset(merged)
    for files, read in ((manifest.count(), token_files.read(manifest)), (index.select("bundle").distinct().count(), warc.read(index))):
        parts = read.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == files > 2 and sum(r[1] for r in parts) in (400, 80)


def test_planes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32).astype("<u4")
        for bits in (False, True):
            assert (token_files.from_planes(token_files.to_planes(ids, bits), n, bits) == ids).all()


def test_files_of_many_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_IDS", 10)
    monkeypatch.setattr(token_files, "PART_DOCS", 3)
    docs = [(i if i else None, np.arange(i * 3, dtype="<u4")) for i in range(12)]
    with open(tmp_path / "x", "wb") as out:
        writer = token_files.PlaneWriter(out)
        for d in docs:
            writer.add([d[0]], d[1], np.array([len(d[1])]))
        writer.close()
    back = list(token_files.PlaneFile(f"file://{tmp_path}/x").documents())
    assert [(k, v.tolist()) for k, v in back] == [(k, v.tolist()) for k, v in docs]


# --- WARC ------------------------------------------------------------------------------------------------------


def test_warc(spark):
    big, small = "<p>" + "é" * 200, "<p>tiny"
    rows = [(5, "http://a/ü\r\nX: y", big), (3, None, big), (9, "u", big), (1, "u", small), (2, "u", small), (4, "u", None), (6, "u", ""), (None, "u", big), (3, None, big), (7, "u", "z" * 400_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    folder = scratch_dir(spark)
    index = warc.write(pages, folder)
    got = by_id(warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    for i, _, html in rows:
        raw = (html or "").encode()
        first = 3 if html == big and i not in (3, None) else None
        assert (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if first else "response", first) in got[i]
    assert sum(map(len, got.values())) == len(rows)
    found = warc.lookup(index, spark.createDataFrame([(5,), (7,), (77,)], "page_id long")).collect()
    assert {(r.page_id, r.record_type) for r in found} == {(5, "revisit"), (7, "response")}
    assert next(bytes(r.payload) for r in found if r.page_id == 7) == b"z" * 400_000
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_bundles_are_seekable(spark, tmp_path):
    import zstandard

    rows = [(i, "u", str(i) * 5000) for i in range(200)]
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    path = index.first().bundle
    bundle = warc.Bundle(path)
    assert len(bundle.frames) > 1
    with open(path.removeprefix("file://"), "rb") as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole == b"".join(bundle.frame(i) for i in range(len(bundle.frames)))  # any Zstandard reader skips the seek table


# --- what the rounds before got wrong --------------------------------------------------------------------------------


def test_lines_of_words_that_share_bytes_stay(spark):
    """Words that differ by a control character, by NULs or in their length aren't the same; clashing columns stay."""
    pairs = [("abcdefg", "abcdefg\x0f"), ("bcdefgh\x08", "bcdefgh"), ("a\x00", "a"), ("b\x00\x00", "b\x00"), ("12345678\x00", "12345678"), ("x" * 16, "x" * 16 + "\x00"), ("q" * 15 + "\x10", "q" * 15)]
    rows = [(2 * i + k, f"{t}\nkeep{i}_{k}") for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    docs = spark.createDataFrame(rows + [(100, "same words here"), (101, "same words here")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("id", "gone", "__id", "__gone", "_id", "_gone", "line")})
    gone = line_dedup.removed_lines(docs)
    assert {(r.doc_id, r.line) for r in gone.collect()} == {(101, 0)}
    left = line_dedup.without_lines(docs, gone)
    assert left.columns == docs.columns and {r.doc_id: r.text for r in left.collect()} == dict(rows) | {100: "same words here", 101: ""}
    raw = np.frombuffer(b"".join(a.encode() for p in pairs for a in p) + bytes(16), np.uint8)
    size = np.array([len(a) for p in pairs for a in p])
    hashes = [line_dedup.word_hashes(raw, np.cumsum(size) - size, size, s) for s in (0, line_dedup.SECOND)]
    assert all(h[2 * i] != h[2 * i + 1] for h in hashes for i in range(len(pairs))) and not set(hashes[0].tolist()) & set(hashes[1].tolist())


def test_long_texts_have_their_fingerprints_in_parts(monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "bb", "Ccc", "é", "z" * 40]) for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 400)] + ["  x\t y\x0b", "w" * 5000, "a " * 300 + "q" * 900]
    whole = [[simhash.fingerprint(t, s) for s in (1, 3, 5)] for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(simhash, "PART", size)
        assert [[simhash.fingerprint(t, s) for s in (1, 3, 5)] for t in texts] == whole


def test_a_worker_keeps_one_table():
    from freshet.llm import common

    made = []
    for key in ("a", "a", "b", "a"):
        assert common.kept(key, lambda key=key: made.append(key) or key) == key
    assert made == ["a", "b", "a"] and list(common._kept) == ["a"]
    common._kept.clear()
    assert common.unused(["a", "b"], ["A", "_b"]) == ["__a", "__b"]
