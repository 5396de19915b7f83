import re
from html import unescape

import numpy as np
import pytest
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401

from tillwork.llm.main_text import Lines, content_lines, main_text, main_texts

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style></head><body>
<header><a href="/">Site name</a><p>Slogan of the site that is rather long, all the same.</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this page, and so on, and so on, at length.</p></div>
<div id="sidebar"><p>Other things to read, a long list of them, more and more of them.</p></div>
{main}
<div class="comments"><h3>Comments</h3><article><p>What a great article, thank you so much for it!</p></article></div>
<form action="/s"><label>Search</label><input name="q"><button>Go</button></form>
<script>var t = "</p> a < b";</script><noscript>Turn it on</noscript>
<div class="ad-box">Buy now, cheaper than ever before, only this very week.</div>
<footer>&copy; 2024 Site &middot; <a href="/i">Imprint</a></footer></body></html>"""
BODY = """<h1>The title &amp; more</h1><p>First   paragraph with <b>bold</b> and
<i>italic</i> text, long enough to be read.<p>Second&nbsp;one, left open, with <a href="/x">a link</a> in it.
<ul><li>an item<li>another item</ul><blockquote>Somebody said so.</blockquote><p>Short.</p>
<table><tr><td>one<td>two</table><p>5 &lt; 6 &#233;&#x1F600;<br>next line</p>"""
TEXT = """The title & more
First paragraph with bold and italic text, long enough to be read.
Second one, left open, with a link in it.
an item
another item
Somebody said so.
Short.
one
two
5 < 6 é\U0001f600 next line"""


@pytest.mark.parametrize(
    "main",
    [
        f"<article>{BODY}</article>",
        f"<main>{BODY}</main>",
        f"<main><article><header>{BODY[: BODY.index('<p>')]}</header>{BODY[BODY.index('<p>') :]}</article></main>",
        f"<div class=content>{BODY}</div>",
        f"<div><div><section id=post>{BODY}</section></div></div>",
        f"<div class='page has-sidebar'><article class='post'>{BODY}</article></div>",
        f"<article>{BODY}<article class='comment'><p>Nice!</p></article></article>",
        f"<ARTICLE>{BODY}<aside>See also</aside><div class='share'>Share this</div></ARTICLE>",
    ],
)
def test_article(main):
    assert main_text(PAGE.format(main=main)) == TEXT


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain text", "plain text"),
        ("<p>one<p>two", "one\ntwo"),
        ("<div><script>x</script><style>y</style></div>", ""),
        ("<article><p>cut of<b>f in the mid", "cut off in the mid"),
        ("<article><p>a &am", "a &am"),
        ("</div></p><article>x</span></article></article>", "x"),
        ("<!-- a --><article><!-- b -->text<!-- c", "text"),
        ("<article><p>a<br/>b<hr/>c</p></article>", "a b\nc"),
    ],
)
def test_broken_or_bare(html, text):
    assert main_text(html) == text


def test_regions_follow_the_density():
    parser = Lines()
    links = "<ul>" + "<li><a href='/x'>go</a></li>" * 12 + "</ul>"
    parser.feed(f"{links}<p>{'word ' * 60}</p><p>{'more ' * 60}</p>{links}")
    parser.close()
    lines = [line for line in parser.lines if line.text]
    content = content_lines(lines)
    dense = np.array([len(line.text) > 50 for line in lines])
    assert content[dense].all()
    assert content.sum() <= 6


def test_test_pages(spark):
    """The pages of the test tables: all blocks of the article, by pattern."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r["page_id"]: r["text"] for r in main_texts(pages).collect()}
    for row in pages.collect():
        body = row["html"].split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:h1|p)>", re.sub("</?b>", "", body.replace("<br>", " ")))
        texts = (re.sub(r"\s+", " ", unescape(p)).strip() for p in parts)
        assert got[row["page_id"]] == "\n".join(t for t in texts if t)


def test_table(table):
    long = "<article>" + "<p>some words of a paragraph</p>" * 20_000 + "</article>"
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, "<p>b"), (2, "v", None), (3, "w", long)]
    rows.append((4, "x", "<div>" * 5000 + "deep"))
    got = tuples(main_texts(table(rows, "page_id long, url string, html string")))
    want = [(i, u, main_text(h)) for i, u, h in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert tuples(main_texts(table([], "page_id long, url string, html string"))) == []


LINKS = "<ul>" + "<li><a href='/x'>go there</a>" * 9 + "</ul>"
LONG = "words of a paragraph that goes on " * 30


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div id=content><h1>Title</h1><p>{0}</p><p>short closing</p></div>", "Title|{0}|short closing"),
        (
            "<div class=post><h1>Title</h1><p>A lead of a few words.</p><div class=body><p>{0}</p><p>{0}</p></div></div>",
            "Title|A lead of a few words.|{0}|{0}",
        ),
        ("<h1>Title</h1><p>A lead of a few words.</p><div>{0}</div>", "Title|A lead of a few words.|{0}"),
        ("<div><h2>Quoted</h2><blockquote>{0}</blockquote><p>That was said by her.</p></div>", "Quoted|{0}|That was said by her."),
        ("<div><ul><li>{0}<li>a short item</ul></div>", "{0}|a short item"),
        (
            "<article><h1>One</h1><p>{0}</p></article><article><h1>Two</h1><p>As short as that.</p></article>",
            "One|{0}|Two|As short as that.",
        ),
        ("<main><h1>Title</h1><article><p>{0}</p></article></main>", "Title|{0}"),
    ],
)
def test_titles_leads_and_closing_blocks_stay(page, text):
    page, text = page.format(LONG), text.format(LONG.strip()).replace("|", "\n")
    assert main_text(page) == text
    assert main_text(f"<body>{LINKS}{page}{LINKS}<p>(c) Site</p></body>") == text


def test_words_of_ids_do_not_drop_article_text():
    kept = (
        f"<section id=discussion><h2 id=related-work>Related work</h2><p>{LONG}</p></section>"
        f"<h2 id=legal-form>Legal form</h2><div id=search-results-of-the-survey><p>It found some.</p></div>"
        f"<div class=discussion><p>{LONG[:300]}</p></div>"
    )
    gone = (
        "<div class=related><a href=/x>Some other story to read here</a></div><div class=search>Search this</div>"
        "<div id=comments><p>What a great article, thank you so much for it!</p></div>"
    )
    got = main_text(f"<body>{LINKS}<article><h1>Title</h1><p>{LONG}</p>{kept}{gone}</article></body>")
    want = ["Title", LONG, "Related work", LONG, "Legal form", "It found some.", LONG[:300]]
    assert got.split("\n") == [t.strip() for t in want]
    page = f"<div><h1>Title</h1><p>{LONG}</p><section id=discussion><h2 id=search>Search</h2><p>{LONG}</p></section></div>"
    assert main_text(page).split("\n") == ["Title", LONG.strip(), "Search", LONG.strip()]


@pytest.mark.parametrize(
    "before", ["<script>var a = '<!--';</script>", "<style>/* <!-- */</style>", "<p title='<!--'></p>"]
)
def test_a_comment_that_is_none(before):
    assert main_text(f"{before}<article><p>text</p><p>more</p></article>") == "text\nmore"
    assert main_text(f"{before}<article><p>text<!-- <p>c</p></article>") == "text"
