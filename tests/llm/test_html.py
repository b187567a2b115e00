import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import types as T

from revlens.llm.html import extract_main_text, main_text
from revlens.llm.registry import table

from ..conftest import SF001

LONG = "A sentence of the article with quite a few words in it, one after the other, so that it is long. "


def test_article_without_its_surroundings():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var x='</p><p>no'</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href='/a'>A</a></li></ul></nav><!-- <p>gone</p> -->"
        f"<div class='cookie-notice'><p>{LONG}</p></div><article><h1>Title &amp; more</h1><p>{LONG}<br>  and&nbsp;\n on</p><p>Short.</p>"
        f"<div class=ad><p>{LONG}</p></div><form><input><p>Name</p></form><ul><li>One</li><li>Two <b>bold</b>x</li></ul><p>{LONG}</p></article>"
        f"<aside><p>{LONG}</p></aside><section id='comments'><article class='comment'><p>{LONG}</p></article></section>"
        f"<footer><p>{LONG}</p></footer></body></html>"
    )
    text, spans = main_text(page)
    a = LONG.strip()
    assert text.split("\n") == ["Title & more", f"{a} and on", "Short.", "One", "Two boldx", a]
    assert spans == [(0, 6)]


def test_blocks_without_article_element():
    page = (
        "<div class='menu'><a href=x>Home</a></div><div><a href=y>Some long link text that leads to other pages of the site</a></div>"
        f"<div id=c><h2>Head</h2><p>{LONG}</p><p>ok.</p><p>{LONG}</p></div><div><a href=z>Next page of the very long list of pages</a></div>"
    )
    assert main_text(page)[0].split("\n") == ["Head", LONG.strip(), "ok.", LONG.strip()]


def test_broken_markup():
    assert main_text("<nav><ul><li>menu<article><p>Body text.")[0] == "Body text."
    assert main_text("a < b and <p>c")[0].split("\n") == ["a < b and", "c"]
    assert main_text("<p>one<!-- open")[0] == "one"
    assert main_text("<script>never closed <p>x</p>") == ("", [])
    assert main_text("<p title='a > b'>x</p>")[0] == "x"
    assert main_text("") == ("", []) and main_text(None) == ("", [])


A = LONG.strip()


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<article class='post has-comments'><p>{A}</p></article>", [A]),
        (f"<div class='content with-sidebar'><p>{A}</p></div>", [A]),
        (f"<div id=page class='share-enabled'><article><p>{A}</p></article></div>", [A]),
        (f"<div class='share'><article><p>{A}</p></article></div><div class=sidebar><p>{A} no</p></div>", [A]),
        (f"<article><h1 class='header'>Title</h1><p>{A}</p></article>", ["Title", A]),
        (f"<article><p>{A}</p><figure><img src=x><figcaption>A picture of it</figcaption></figure></article>", [A, "A picture of it"]),
        (f"<article><p>{A} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>", [f"{A} x=1 holds"]),
        (f"<article><p>{A}</p><pre><code>f() <span class='comment'># why</span></code></pre></article>", [A, "f() # why"]),
        (f"<article><p>{A} press <button>Stop</button> now</p><button>Share</button></article>", [f"{A} press Stop now"]),
        (f"<article><p>{A}</p><ul><li><a href=a>First source</a></li><li><a href=b>Second</a></li></ul></article>", [A, "First source", "Second"]),
        (f"<div id=c><p>{A}</p><p>so.</p><p>yes.</p><p>no.</p><p>ok.</p></div><div><a href=z>Next page of the long list of pages</a></div>", [A, "so.", "yes.", "no.", "ok."]),
        (f"<div><p>Hi.</p><p>Dear.</p><p>All.</p><p>You.</p><p>{A}</p></div>", ["Hi.", "Dear.", "All.", "You.", A]),
        (f"<main><div class='comment-body'><p>{A} c</p></div><p>{A}</p></main>", [A]),
        (f"<article><p>{A}</p></article><div class='related'><article><p>{A} r</p></article></div>", [A]),
        (f"<section id=comments class='post-comments'><article class=comment><p>{A} c</p></article></section><article><p>{A}</p></article>", [A]),
        (f"<article><p>{A}</p><div class='share-buttons'><p>Tell your friends about this</p></div></article>", [A]),
    ],
)
def test_articles_keep_their_text(page, want):
    assert main_text(f"<html><body><nav><ul><li><a href=h>Home</a></li></ul></nav>{page}<footer><p>{A}</p></footer></body></html>")[0].split("\n") == want


@pytest.mark.parametrize("piece", ["<a ", "<a '", '<a "', "<a'\">", "<", "<!", "<!--", "</", "<p x='", "<div class='ad'>", "<div>", "<script", "&", "<article>", "</div>"])
def test_time_is_linear_on_broken_markup(piece):
    page = piece * ((1 << 20) // len(piece))
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 15


def plain_text(page):
    """What a plain parser makes of the given pages: the blocks of the article element, in order."""
    blocks = []

    class Parser(HTMLParser):
        inside = skip = 0
        now = ""

        def end_block(self):
            if " ".join(self.now.split()):
                blocks.append(" ".join(self.now.split()))
            self.now = ""

        def handle_starttag(self, tag, attrs):
            if tag == "article":
                self.inside = 1
            elif tag in ("script", "style") or tag == "div" and ("class", "ad") in attrs:
                self.skip += 1
            if tag == "br":
                self.now += " "
            elif tag != "b":
                self.end_block()

        def handle_endtag(self, tag):
            if tag not in ("b", "br"):
                self.end_block()
            if tag == "article":
                self.inside = 0
            elif tag in ("script", "style", "div"):
                self.skip -= 1

        def handle_data(self, data):
            if self.inside and not self.skip:
                self.now += data

    p = Parser(convert_charrefs=True)
    p.feed(page)
    p.end_block()
    return "\n".join(blocks)


def test_all_given_pages_against_a_plain_parser(spark):
    pages = table(spark, SF001, "pages")
    want = {r.page_id: plain_text(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    assert got == want and len(got) == 250 and all(got.values())


def test_table_of_pages(spark):
    schema = T.StructType().add("page_id", "long").add("url", "string").add("html", "string").add("text", "string").add("n_chars", "string")
    rows = [(1, "u", "<article><p>Hé</p></article>", "x", "y")] * 2 + [(None, None, None, None, None), (2, "v", "", "x", "y"), (3, "w", f"<p>{LONG * 3000}</p>", "", "")]
    got = extract_main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.text[:5], r.n_chars) for r in got) == [(0, "", 0), (1, "Hé", 2), (1, "Hé", 2), (2, "", 0), (3, "A sen", len(LONG) * 3000 - 1)]
    assert extract_main_text(spark.createDataFrame([], schema)).count() == 0
