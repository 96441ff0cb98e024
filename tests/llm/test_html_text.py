from __future__ import annotations

import html
import itertools
import math
import re
import time

import pytest

from subscope.llm import html_text as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><p>Site name and slogan</p></header><div class="sidebar"><p>Side text that is long enough to matter</p></div>
<div id="content"><h1>A &lt;title&gt; &amp; more</h1><p>First   paragraph&nbsp;of <b>the
story</b>.<br>After a break.<p>Second one, with <a href="x">a link</a>.<ul><li>one<li>two</ul>
<script>var a = "<p>no</p>";</script><div class="comments"><p>A reader's opinion.</p></div>
<form><p>Sign up</p></form></div><div class="cookie-notice">We use cookies</div><footer>&copy; me</footer></body></html>"""


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    return h.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_given_pages_give_their_article(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in h.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = (re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        assert r.text == want and r.n_chars == len(want)


@pytest.mark.parametrize("trained", [True, False])
def test_unmarked_page(fitted, trained):
    text = h.main_text(fitted if trained else h.Model(), PAGE)
    assert text.split("\n") == [
        "A <title> & more", "First paragraph of the story. After a break.", "Second one, with a link.", "one", "two"]


NAMES = ["post no-ads", "article form-free", "entry tags-travel", "story legal-news", "content share-enabled",
         "main-search-results", "comment-count-3 article", "no-sidebar", "x1"]


def unmarked(source, name):
    return re.sub(r"<(/?)(?:article|main)\b[^>]*>", lambda m: "</div>" if m[1] else f'<div class="{name}">', source)


def test_pages_without_a_mark_of_their_article(fitted, spark, sf_dir):
    """The same text comes out when the article sits in a div, whatever its name holds."""
    for i, row in enumerate(spark.read.parquet(f"{sf_dir}/pages.parquet").collect()):
        name = NAMES[i % len(NAMES)]
        assert h.main_text(fitted, unmarked(row.html, name)) == h.main_text(fitted, row.html), (row.page_id, name)


@pytest.mark.parametrize("name", NAMES)
def test_names_that_only_hold_a_noise_word(fitted, name):
    story = "".join(f"<p>Sentence {i} of a story that goes on for a while.</p>" for i in range(30))
    noise = '<div class="ad-box"><p>Buy this now</p></div><div class="site-footer"><p>All rights</p></div>'
    for model in (fitted, h.Model()):
        got = h.main_text(model, f'<html><body><div class="{name}">{story}</div>{noise}</body></html>').split("\n")
        assert got == [f"Sentence {i} of a story that goes on for a while." for i in range(30)]


def test_long_comments_beside_a_named_article(fitted):
    comments = "".join(f'<div class="comment-body"><p>Opinion {i} of a reader who writes a lot.</p></div>' for i in range(40))
    for inside in ("<div class='post'><p>The text itself.</p></div><div class='comment-list'>{}</div>",
                   "<article><p>The text itself.</p><div class='comment-list'>{}</div></article>"):
        if "article" in inside:
            inside = inside.replace("itself.", "itself" + " and so on" * 40 + ".")
        got = h.main_text(fitted, "<body>" + inside.format(comments) + "</body>")
        assert got.startswith("The text itself") and "Opinion" not in got


@pytest.mark.parametrize("source", [
    "<p>start</p>" + "<b>" * 100_000 + "end", "<p>start</p>" + "<a \"'" * 50_000, "<p>start</p>" + '<a b="" ' * 50_000 + 'c=">"',
    "<p>start</p>" + '<a b=">" ' * 50_000, "<i><div>" + "<b></i>" * 50_000 + "<p>start</p>", "<p>start</p>" + "<!" * 100_000,
    "<div>" * 50_000 + "<p>start</p>" + "</p>" * 50_000])
def test_reading_takes_linear_time(source):
    began = time.process_time()
    page = h.Page(source)
    assert time.process_time() - began < 2
    assert any("start" in text for text, _, _ in page.runs)


def test_broken_quotes_keep_the_text():
    for tag in ("<a title=it's>", '<a title="open>', "<a 'x\">", '<p class="x"y"z">'):
        runs = [t for t, _, _ in h.Page(f"<p>one</p>{tag}two<p>three</p>").runs]
        assert runs == ["one", "two", "three"], tag
    assert [t for t, _, _ in h.Page("<a title='a > b' x=\"c > d\">two</a><!-- > three").runs] == ["two"]


def test_marginals_are_exact(fitted):
    page = h.Page("<div><p>some words here</p><div class=nav><a>x</a></div></div>")
    own = [fitted.unary(t, f) for t, f in zip(page.tag, page.features(), strict=True)]
    n = len(page.tag)
    mass = [[0.0, 0.0] for _ in range(n)]
    for states in itertools.product((0, 1), repeat=n):
        energy = -1.0 * states[0]
        for i in range(1, n):
            e = fitted.edges[page.tag[i] in h.STRUCTURE]
            energy += own[i] * states[i] + e[2 * states[page.parent[i]] + states[i]]
        for i in range(n):
            mass[i][states[i]] += math.exp(energy)
    for got, (a, b) in zip(fitted.marginals(page), mass, strict=True):
        assert math.isclose(got, math.log(b / a), abs_tol=1e-6)


def test_odd_pages(spark):
    sources = [None, "", "plain text only", "<p>unclosed", "<div " * 300, "<b></i></p></div>", "&#x41;&bogus;",
               "<article>" + "<p>word " * 20_000, "<!-- <article>x</article>", "<script>never closed <p>x</p>"]
    rows = [(i, None, s, "extra") for i, s in enumerate(sources)] + [(1, None, "", "extra")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in h.extract(frame).collect()}
    assert len(got) == len(sources) and h.extract(frame).count() == len(rows)
    assert got[0].text == "" and got[0].n_chars == 0 and got[7].text.count("word") == 20_000 and got[9].text == ""
    assert h.extract(frame.limit(0)).count() == 0
