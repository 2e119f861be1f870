"""HTML extraction on pages of known text, and top-k search against all scores."""

import math
import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortia.llm import html_text, topk

PARTS = {
    "nav": "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>",
    "header": "<header><h1>Site</h1><p>Slogan that is long enough to look like text.</p></header>",
    "aside": "<aside><p>Side bar text, quite a lot of it, in one long paragraph.</p></aside>",
    "ad": "<div class='ad box'><p>Buy now! This advert has many words and hardly any tags in it at all.</p></div>",
    "cookie": "<div id='cookie-notice'>We use cookies to make this site better for everyone who reads it.</div>",
    "form": "<form><p>Your mail</p><input name='m'><textarea>here</textarea><select><option>One</option></select></form>",
    "script": "<script>var t = '<p>not text</p>';</script><style>p { color: red }</style>",
    "comment": "<!-- <p>hidden</p> -->",
    "comments": "<section class='comments'><h2>Comments</h2><p>A reader wrote a very long comment about all this.</p></section>",
    "hidden": "<div hidden>secret</div><div style='display: none'>secret too</div>",
    "footer": "<footer>&copy; someone &middot; all of it</footer>",
}


def page(article, before=("nav", "header", "ad", "cookie", "script", "comment"), after=("aside", "form", "comments", "hidden", "footer")):
    return (
        "<!DOCTYPE html><html><head><meta charset=utf-8><title>T</title></head><body class='has-sidebar'>"
        + "".join(PARTS[p] for p in before) + article + "".join(PARTS[p] for p in after) + "</body></html>"
    )


CASES = [
    ("<article><h1>Title</h1><p>One &amp; two.</p><p>Three\n  four<br>five.</p></article>", "Title\n\nOne & two.\n\nThree four five."),
    ("<article><p>a<b>b</b>c <i>d</i></p><ul><li>x<li>y</ul></article>", "abc d\n\nx\n\ny"),
    ("<article><p><b>open <p>next</b></p></article>", "open\n\nnext"),
    ("<article><p>1 < 2 &lt; 3 &eacute;&#233;&#x41; &nope; &amp</p></article>", "1 < 2 < 3 ééA &nope; &"),
    ("<main><div><h2>H</h2><table><tr><td>c1</td><td>c2</td></tr></table><pre>p  q</pre></div></main>", "H\n\nc1\n\nc2\n\np q"),
    ("<article><p>Before.</p><div class='ad'>Advert</div><script>x</script><p>After.</p></article>", "Before.\n\nAfter."),
    ("<article>short</article>", "short"),
    ("<article></article>", ""),
    ("<div class='wrap sidebar-layout'><article><p>kept whole</p></article></div>", "kept whole"),
    ("<div id=x><p>" + "Long plain text without an article element. " * 9 + "</p><p>" + "And a second part of it. " * 9 + "</p></div>",
     ("Long plain text without an article element. " * 9).strip() + "\n\n" + ("And a second part of it. " * 9).strip()),
]


@pytest.mark.parametrize("article, text", CASES)
def test_article_of_a_page(article, text):
    assert html_text.main_text(page(article)) == text


LONG = ("Plain sentences of an article that says a good deal in one long paragraph. " * 4).strip()
NAMED = [
    ("<section id='related-work'><h2 id='sharing'>Sharing</h2><p>a</p></section>", "Sharing\n\na"),
    ("<h2 id='share-prices'>Prices</h2><p>a</p>", "Prices\n\na"),
    ("<h2 class='notice'>Take notice</h2><p>a</p>", "Take notice\n\na"),
    ("<div id='ad-hoc-methods'><p>a</p></div><section id='menu-design'><p>b</p></section>", "a\n\nb"),
    ("<section id='comments'><p>a</p></section>", "a"),
    (f"<section class='notice'><p>{LONG}</p></section>", LONG),
    ("<p>a</p><div class='share-buttons'><a href='/x'>Post</a> <a href='/y'>Mail</a></div><div class='ad-banner'>buy</div>", "a"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='application/x-tex'>x=2</annotation></math> holds</p>", "so x=2 holds"),
]


@pytest.mark.parametrize("body, text", NAMED)
def test_names_that_are_everyday_words(body, text):
    assert html_text.main_text(page(f"<article>{body}</article>")) == text


@pytest.mark.parametrize("wrapper", ["class='content no-sidebar'", "id='page' class='has-header'", "class='header'", "id='menu'", "class='sidebar'"])
def test_names_of_wrappers_do_not_empty_a_page(wrapper):
    whole = f"<body><nav>Home</nav><div {wrapper}><p>{LONG}</p><div class='share'><a href='/x'>Post</a></div><p>{LONG}</p></div></body>"
    assert html_text.main_text(whole) == f"{LONG}\n\n{LONG}"


def test_formulas_do_not_thin_out_an_article():
    formula = "<math>" + "<mi>x</mi><mo>+</mo>" * 40 + "</math>"
    whole = f"<body><div><p>{LONG}</p><p>{LONG} {formula} {LONG}</p><p>{LONG}</p></div></body>"
    assert html_text.main_text(whole) == f"{LONG}\n\n{LONG} {'x+' * 40} {LONG}\n\n{LONG}"


SAID = "".join(
    f"<div class=c{i}><span class=author>Ann</span><time>3 May</time><p>I liked this a lot, thanks, and part {i} most.</p></div>"
    for i in range(4)
)
STORY = f"<p>{LONG}</p>" * 3
TOLD = "\n\n".join([LONG] * 3)
LAYOUTS = {
    "headline in a header": (f"<article><header><nav><a href=x>Up</a></nav><h1>Head</h1><p>By X</p></header>{STORY}</article>", f"Head\n\n{TOLD}"),
    "header of main": (f"<main><header><h1>Head</h1></header>{STORY}</main>", f"Head\n\n{TOLD}"),
    "headline before": (f"<div><h1>Head</h1><article>{STORY}</article></div>", f"Head\n\n{TOLD}"),
    "a headline of its own": (f"<div><h1>Site</h1><article><h1>Head</h1>{STORY}</article></div>", f"Head\n\n{TOLD}"),
    "lead and end in main": (
        f"<main><h1>Head</h1><p>Short lead.</p><article>{STORY}</article><p>An end.</p></main>",
        f"Head\n\nShort lead.\n\n{TOLD}\n\nAn end."),
    "two articles": (f"<div><article>{STORY}</article><article>{STORY}</article></div>", f"{TOLD}\n\n{TOLD}"),
    "two articles in main": (f"<main><article>{STORY}</article><article>{STORY}</article></main>", f"{TOLD}\n\n{TOLD}"),
    "cards of other stories": (
        f"<main><article>{STORY}</article><section class=more>" + "<article><h2><a href=x>Other</a></h2><a href=y>Read it</a></article>" * 3
        + "</section></main>", TOLD),
    "unnamed comments": (f"<article>{STORY}<section class=talk><h3>Discussion</h3>{SAID}</section></article>", TOLD),
    "unnamed comments after": (f"<div class=content>{STORY}</div><div class=user-responses><h3>What you say</h3>{SAID}</div>", TOLD),
    "dates without authors": (f"<article>{STORY}<div><time>1914</time><p>War.</p></div><div><time>1918</time><p>Peace.</p></div></article>",
                              f"{TOLD}\n\n1914\n\nWar.\n\n1918\n\nPeace."),
    "an author and a date": (f"<article><div><span class=author>Ann</span><time>May</time></div>{STORY}</article>", f"AnnMay\n\n{TOLD}"),
    "posts by authors": (
        "".join(f"<div class=post><span class=author>Ann</span><time>May</time>{STORY}</div>" for _ in range(1)), f"AnnMay\n\n{TOLD}"),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(layout):
    body, text = LAYOUTS[layout]
    assert html_text.main_text(f"<html><body><nav><a href=/>Home</a></nav>{body}<footer>Foot</footer></body></html>") == text


@pytest.mark.parametrize("cut", range(1, 60, 7))
def test_cut_off_page(cut):
    whole = page("<article><p>All of this is text.</p></article>", after=())
    assert "All of this is text.".startswith(html_text.main_text(whole[: len(whole) - cut]))


def test_odd_pages():
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("just text") == "just text"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert html_text.main_text(deep) == "deep"
    assert html_text.main_text("<p title='a > b'>x</p><p class=>y") == "x\n\ny"


@pytest.mark.parametrize("unit", ["<div>", "<font><p>x", "<b>", "<ul><li>x", "</i><p><span>"])
def test_pages_of_200_000_open_tags_take_seconds(unit):
    start = time.time()
    html_text.main_text(unit * 200_000 + "deep")
    assert time.time() - start < 60


def test_extract_keeps_rows(spark):
    rows = [(1, "u", page("<article><p>t</p></article>"), "x"), (1, "u", page("<article><p>t</p></article>"), "x"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html_text.extract(df).collect()), key=repr) == [(1, "u", "t"), (1, "u", "t"), (None, None, "")]
    assert html_text.extract(df.where("1 = 0")).count() == 0


def brute(rows, k):
    whole = [(i, [math.floor(64.0 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in whole:
        if i % 20 == 0:
            scores = [(sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in whole if j != i]
            best = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
            out += [(i, rank, j, s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


def found(df, k=20, **how):
    ready = topk.usable(df)
    index = topk.build_index(ready, **how)
    return sorted(map(tuple, topk.search(index, ready.where(F.col("vec_id") % 20 == 0), k).collect()))


SCHEMA = "vec_id long, embedding array<float>, block int, values string"


@pytest.mark.parametrize("per_block", [4096, 37])
@pytest.mark.parametrize("kind", ["normal", "grid", "equal"])
def test_best_of_many(spark, per_block, kind):
    r = np.random.default_rng(3)
    vectors = {"normal": r.normal(size=(300, 16)), "grid": r.integers(-2, 3, (300, 16)) / 4, "equal": np.ones((300, 16))}[kind]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)
    assert found(df, per_block=per_block) == brute(rows, 20)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5]), (20, [0.25, 0.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]),
            (5, [-1.0, 2.0]), (5, [-1.0, 2.0]), (6, []), (7, [0.5]), (-20, [0.0, 0.0]), (40, [])]
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)
    assert found(df) == brute(rows, 20)
    assert found(df, k=2) == brute(rows, 2)
    assert found(df.where("1 = 0")) == []


def test_large_components(spark):
    rows = [(0, [3e7, 1.0]), (1, [2e7, -5.0]), (2, [-3e7, 0.0]), (20, [0.5, 0.5])]
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)
    assert found(df) == brute(rows, 20)


def test_a_query_stops_before_the_last_segment():
    """Clear winners need no weak segments."""
    import pyarrow as pa

    r = random.Random(1)
    rows = [[float(r.randint(-3, 3)) for _ in range(32)] for _ in range(500)]
    for k in range(20):
        rows[k] = [float(x) for x in r.choices([-600, 600], k=32)]
    table = pa.table({"block": pa.array([0] * 500, pa.int32()), "vec_id": list(range(500)), "values": rows})
    row = topk._segments(table).to_pylist()[0]
    block, seen = topk.Block(row), defaultdict(int)
    for at, (segment, left) in enumerate(block.segments):
        block.segments[at] = (CountingMatrix(segment, seen, at), left)
    hits = list(block.search(np.array([7]), np.array([rows[7]]).astype(np.int64), 5))
    assert len(hits) == 5 and len(seen) < len(block.segments)


class CountingMatrix:
    def __init__(self, matrix, seen, number):
        self.matrix, self.seen, self.number = matrix, seen, number

    def __rmatmul__(self, other):
        self.seen[self.number] += 1
        return other @ self.matrix

    __array_ufunc__ = None
