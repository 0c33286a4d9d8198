import html
import random
import re
import time
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest

from rivulet.llm import html_text, queries

NONE = np.zeros(0, dtype=np.int64)
PAGES = [
    ('<body><div class="page has-sidebar"><header><h1>Site</h1></header><div id="sidebar">x</div><div class="content"><h1>T</h1><p>Hello <b>wor</b>ld&nbsp;&amp; co<p>two<ul><li>a<li>b</ul></div><div class="comments"><p>bad</p></div></div>', "T Hello world & co two a b"),
    ('<main><p>one</p><form>f<input></form><section class="comments"><article class="comment">c</article></section></main><aside>z', "one"),
    ('<article><header><h1>Title</h1></header>text <a href="x>y">link</a><div class=ad>buy</div><p>end &lt;tag&gt; <script>x</p></script></article><article class="comment">no</article><foo', "Title text link end <tag>"),
    ("<article><p>a<br>b</p>\n <table><tr><td>1<td>2</table><pre>x\n  y</pre></article>", "a b 1 2 x y"),
    ("<article><p>kept</p><nav><p>menu</p></nav><!-- <p>no</p> --><style>p{}</style><p>also &#x263a;&eacute;</article><footer>f</footer>", "kept also ☺é"),
    ('<article><p>one</p><div role="complementary">side</div><div class="cookie-notice">ok?</div><p hidden>gone</p><p>two', "one two"),
    ("<html><head><title>t</title></head><body><p>only <i>body</i></p><noscript>n</noscript></body></html>", "only body"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ('<div class="layout widget"><h1>T</h1><p>text</p><div class="banner"><h1>Buy</h1></div></div><div id="sidebar"><p>x</p></div>', "T text"),
    ('<div class="main-area widget"><article><p>inside a wrapper</p></article><article class="comment">no</article></div><p>y', "inside a wrapper"),
    ("plain &am", "plain &am"),
    ("<p", ""),
    ("", ""),
    (None, ""),
    ("<div>" * 300 + "deep", "deep"),
]


@pytest.mark.parametrize(("source", "want"), PAGES)
def test_rules(source, want):
    assert html_text.extract_text(source or "", NONE) == (want, 0)


SHAPES = {
    "deep": lambda n: "<div>" * n + "deep" + "</x>" * n + "</div>" * n + "<b>" * n + "end",
    "articles": lambda n: "<article><p>a</p></article>" * n,
    "nested articles": lambda n: "<article>a" * n,
    "open inline": lambda n: "<b>" * n + "<p>x" * n,
    "adverts": lambda n: "<div class=ad>x</div>" * n + "<article>y</article>" * n,
    "text at every depth": lambda n: "<div>t" * n,
    "items in blocks": lambda n: "<div>" * n + "<li>x" * n,
    "cells": lambda n: "<table>" + "<tr><td>x<div>y" * n,
    "broken tags": lambda n: "<a '" * n + "<b \">" * n + "<!--" * n,
    "many classes": lambda n: "<p " + 'class="a b" ' * n + ">x",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_odd_pages_take_linear_time(shape):
    def seconds(n):
        source = SHAPES[shape](n)
        began = time.perf_counter()
        page = html_text.Page(source)
        page.subtrees()
        page.main(np.ones(len(page.runs), dtype=bool))
        return time.perf_counter() - began

    seconds(1_000)
    # Thirty times the page takes some thirty times the time; a quadratic step would take 900 times.
    assert seconds(30_000) < 120 * max(min(seconds(1_000) for _ in range(3)), 0.002)


def test_hosts(spark):
    urls = ["HTTP://user@WWW.Example.com:80/a", "https://b.org", None, "", "x", "/a/b", "mailto:a@b"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(html_text.host_column().alias("h"))
    assert [r.h for r in rows.collect()] == ["example.com", "b.org", "", "", "", "", ""]


def untold(i):
    """A page whose boilerplate has no telling element, class or id."""
    menu = "".join(f"<div><span><a href=/{k}>{k}</a></span></div>" for k in ("Start", "World", "Sport"))
    return f"<body><div><div>{menu}</div><p>Our paper, since 1901</p><div><h2>Story {i}</h2><p>what happened on day {i}</p><p>and {i * 7} more</p></div><div><p>Write to us</p><p>All rights</p></div></div></body>"


def test_templates_without_telling_names(spark, monkeypatch):
    rows = [(i, f"https://a.org/{i}", untold(i)) for i in range(8)]
    got = {r.page_id: (r.text, r.template_chars) for r in html_text.extract(pages(spark, rows)).collect()}
    boilerplate = ["Start", "World", "Sport", "Our paper, since 1901", "Write to us", "All rights"]
    assert got == {i: (f"Story {i} what happened on day {i} and {i * 7} more", sum(map(len, boilerplate))) for i in range(8)}
    # Without templates, the rules alone would leave all of it.
    monkeypatch.setattr(html_text, "templates", lambda p: spark.createDataFrame([], "host string, gone array<long>"))
    assert all("Write to us" in r.text and r.template_chars == 0 for r in html_text.extract(pages(spark, rows)).collect())


def test_template_counts_by_brute_force(spark):
    """Subtrees counted by a plain parser of nested blocks, page by page."""

    class Blocks(HTMLParser):
        def __init__(self, source):
            super().__init__()
            self.open, self.found = [], set()
            self.feed(source)

        def handle_starttag(self, tag, attrs):
            self.open.append((tag, []))

        def handle_data(self, data):
            for tag, texts in self.open:
                texts.append(data)

        def handle_endtag(self, tag):
            name, texts = self.open.pop()
            if name in ("div", "p", "h2") and texts:
                self.found.add((name, tuple(texts)))

    rng = random.Random(3)
    sources = {i: "<body>" + "".join(f"<div><p>{rng.choice('abcd')}</p><h2>{rng.choice('xy')}</h2></div>" for _ in range(4)) + f"<p>only {i}</p></body>" for i in range(40)}
    rows = [(i, f"https://h{i % 3}.org/{i}", s) for i, s in sources.items()]
    want = {}
    for h in range(3):
        count = Counter(x for i, s in sources.items() if i % 3 == h for x in Blocks(s).found)
        n = sum(i % 3 == h for i in sources)
        want[f"h{h}.org"] = sum(c >= max(3, n / 2) for c in count.values())
    assert {r.host: len(r.gone) for r in html_text.templates(pages(spark, rows)).collect()} == want


def test_a_repeated_article_is_no_template(spark):
    rows = [(i, f"https://a.org/{i}", f"<body><div><article><p>one and the same story</p></article></div><div class=ad>{i}</div></body>") for i in range(6)]
    assert set(text_of(html_text.extract(pages(spark, rows))).values()) == {"one and the same story"}


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, host string, body int")


def text_of(found):
    return {r.page_id: r.text for r in found.collect()}


def test_site_templates(spark):
    rows = [(i, f"https://a.org/{i}", f"<body><div><p>Welcome to our shop</p></div><div><p>page {i} text</p></div><div><p>All rights</p></div></body>") for i in range(6)]
    rows += [(10 + i, f"https://b.org/{i}", f"<body><div><p>Welcome to our shop</p></div><p>b {i}</p></body>") for i in range(2)]
    rows += [(20 + i, f"https://c.org/{i}", f"<article><p>post {i}</p><div><p>Support us today</p></div></article>") for i in range(12)]
    rows += [(40 + i, f"https://d.org/{i}", f"<article><p>post {i}</p><p>Common line</p></article>" if i % 4 == 0 else f"<article><p>post {i}</p></article>") for i in range(24)]
    rows += [(70 + i, f"https://e.org/{i}", "<article><p>the very same page</p></article>") for i in range(15)]
    rows += [(90, None, "<body><p>no host</p></body>"), (91, "::", None), (10, "https://b.org/0", rows[6][2])]
    got = text_of(html_text.extract(pages(spark, rows)))
    assert [got[i] for i in range(6)] == [f"page {i} text" for i in range(6)]
    assert got[10] == "Welcome to our shop b 0"  # two pages make no template
    assert got[23] == "post 3"
    assert got[40] == "post 0 Common line"  # a quarter of the pages is not most of them
    assert got[70] == "the very same page"  # equal pages count once
    assert (got[90], got[91]) == ("no host", "")
    assert html_text.extract(pages(spark, [])).count() == 0


def test_templates_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(html_text, "BROADCAST_HASHES", 0)
    rows = [(i, f"https://a.org/{i}", f"<body><div><p>Menu text</p></div><p>page {i}</p></body>") for i in range(5)]
    assert text_of(html_text.extract(pages(spark, rows))) == {i: f"page {i}" for i in range(5)}


def article(source):
    found = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
    for pattern, by in ((r"</?(p|h1|br)>", " "), (r"<[^>]*>", ""), (r"<[^>]*$", "")):
        found = re.sub(pattern, by, found)
    return " ".join(html.unescape(found).split())


def test_op9(spark, data):
    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = queries.QUERIES["op9_html_text"](spark, data).collect()
    assert {r.page_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
    assert all(r.template_chars >= 0 for r in rows)


def test_versions_of_a_menu_beside_an_article(spark):
    rows = [(i, f"https://a.org/{i}", f"<body><div>menu {i % 20}</div><article><p>story {i}</p></article></body>") for i in range(100)]
    found = html_text.extract(pages(spark, rows)).collect()
    assert all(r.text == f"story {r.page_id}" and r.template_chars == len(f"menu {r.page_id % 20}") for r in found)
