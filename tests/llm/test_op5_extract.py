"""Blocks, minimum cut against all labellings, and extraction of odd pages."""

import itertools
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmetrics.llm.op5_extract import DEFAULT, Network, blocks, extract_main_text, main_text


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 7), st.data())
def test_minimum_cut_equals_the_cheapest_labelling(n, data):
    cost = [(data.draw(st.integers(0, 9)), data.draw(st.integers(0, 9))) for _ in range(n)]
    edges = [(i, j, data.draw(st.integers(0, 6))) for i in range(n) for j in range(i + 1, n) if data.draw(st.booleans())]
    net = Network(n + 2)
    for i, (content, aside) in enumerate(cost):
        net.join(n, i, content)
        net.join(i, n + 1, aside)
    for i, j, c in edges:
        net.join(i, j, c, c)
    side = net.source_side(n, n + 1)[:n]

    def price(inside):
        return sum(c[1] if x else c[0] for c, x in zip(cost, inside, strict=True)) + sum(c for i, j, c in edges if inside[i] != inside[j])

    assert price(side) == min(price(x) for x in itertools.product([True, False], repeat=n))


ARTICLE = "<p>The first paragraph of the article is long enough to be read as prose. It has sentences.</p>"


def text_of(page):
    return main_text(DEFAULT, page)[0]


def test_parts_around_the_article_go():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice">We use cookies on this site. Please agree to all of them.</div>
    <article><header><h1>Head &amp; line</h1></header>{ARTICLE}<p title=it's>Second&nbsp;one, with <b>bold</b>
    text<br>and a break.<p>An unclosed one that goes on for some more words. It ends here.</article>
    <section id="comments"><p>A reader writes a rather long comment on this. It is not the article.</p></section>
    <form><p>Subscribe to our newsletter with your address, please.</p></form><aside>More</aside><footer>&copy; x</footer><script>var a="</p>";</script></body>"""
    assert text_of(page) == (
        "Head & line The first paragraph of the article is long enough to be read as prose. It has sentences. "
        "Second one, with bold text and a break. An unclosed one that goes on for some more words. It ends here."
    )


def test_without_an_article_element_prose_is_found():
    prose = " ".join(["This is one of many sentences in the body of the page, and it is long enough."] * 6)
    page = f"<body><ul class=menu><li><a href=/>A</a><li><a href=/b>B</a></ul><div id=content><p>{prose}</p><p>{prose}</p></div><div class=ad>Buy now</div></body>"
    assert text_of(page) == f"{prose} {prose}"


PROSE = " ".join(["This is one of many sentences in the body of the page, and it is long enough."] * 6)


@pytest.mark.parametrize(
    "page",
    [
        "<body><div class='page-with-sidebar'><article>{}</article><div class=sidebar><p>More to read here, a whole sentence.</p></div></div></body>",
        "<body><div id='content-sidebar'><h1>H</h1>{}</div><footer>f</footer></body>",
        "<body><article class='post category-social'>{}</article></body>",
        "<body><main class='open-comments'>{}<section class=comments><p>A reader writes. It is not the article, of course.</p></section></main></body>",
        "<body><form id='aspnetForm' class=search><nav>x</nav><h1>H</h1>{}</form></body>",
    ],
)
def test_what_wraps_the_whole_page_bars_nothing(page):
    text = text_of(page.format(f"<p>{PROSE}</p><p>{PROSE}</p>"))
    assert text.removeprefix("H ") == f"{PROSE} {PROSE}"


def test_a_headline_in_a_named_article_stays():
    assert text_of(f"<body><header><h1>Site</h1></header><div id=content><header><h1>The headline</h1></header><p>{PROSE}</p></div></body>") == f"The headline {PROSE}"


def test_formulas_and_objects_are_text():
    page = f"<article><p>{PROSE} It is <math><mi>a</mi><mo>+</mo><mi>b</mi></math> here.</p><object data=x><p>{PROSE}</p></object></article>"
    assert text_of(page) == f"{PROSE} It is a+b here. {PROSE}"


def test_depth_is_right_after_very_deep_elements():
    found = blocks("<section>" * 515 + "a" + "</section>" * 3 + "<p>b" + "</section>" * 512 + "<div>c")
    assert [len(b.path) for b in found] == [512, 512, 1] and [b.text for b in found] == ["a", "b", "c"]


def test_odd_pages():
    assert text_of(None) == "" and text_of("") == "" and text_of("<nav>x</nav>") == "" and text_of("<!-- open") == ""
    assert [b.text for b in blocks("a < b <p>c&lt;d<script>x")] == ["a < b", "c<d"]
    start = time.time()
    for page in ("<" * 200_000, "<div>x" * 40_000, "<b>" * 60_000 + "</i>" * 60_000, "<p a='" * 30_000, "<!--" * 60_000, "&" * 200_000, "<p>Some words. " * 20_000 + "<li><a>z</a>" * 20_000):
        main_text(DEFAULT, page)
    assert time.time() - start < 60


def test_table_with_nulls_clashing_columns_and_repeats(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article><footer>f</footer>")] * 2 + [(None, None, None), (3, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    got = extract_main_text(df).collect()
    assert len(got) == 4 and {r["n_chars"] for r in got} == {0, len(got[0]["text"])} and got[0] == got[1]
    assert extract_main_text(df.limit(0)).collect() == []
    assert np.isfinite(DEFAULT).all()
