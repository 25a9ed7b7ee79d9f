"""Main text of pages built around a known article, in several layouts, and of the given pages by SQL."""

import random

import pytest

from marketloom.llm import main_text
from marketloom.llm.queries import QUERIES, SQL
from tools import compare

MENU = '<ul>' + "".join(f'<li><a href="/{w}">{w} section</a></li>' for w in ("home", "news", "about", "contact", "shop")) + "</ul>"
LEGAL = "&copy; 2024 example.org &middot; All rights reserved. Terms of use and privacy apply to all visitors of these pages."
BUY = "Buy the best shoes of the season now, with free delivery to every country and a discount for new customers only today."
SAID = "What a marvellous text, I read it twice and sent it to all my friends and to my family, who liked it as well."

LAYOUTS = {
    "article": f"<header><a href=/>Site</a><nav>{MENU}</nav></header><article>{{}}</article><aside><p>{BUY}</p></aside><footer>{LEGAL}</footer>",
    "main": f"<nav>{MENU}</nav><main><div>{{}}</div><section id='comments'><h2>Comments</h2><p>{SAID}</p><p>{SAID}</p></section></main>"
            f"<footer><p>{LEGAL}</p></footer>",
    "classes": f"<div class='site-header'><h1>The daily page</h1>{MENU}</div><div id='cookie-notice'>We use cookies. {BUY}</div>"
               f"<div class='content'>{{}}</div><div class='sidebar'><h3>More</h3><p>{BUY}</p></div><div id='footer'>{LEGAL}</div>",
    "unnamed": f"<div>{MENU}</div><div>{{}}</div><div>{MENU}</div><div>{LEGAL}</div>",
    "table": f"<table><tr><td>{MENU}</td><td>{{}}</td></tr><tr><td colspan=2>{LEGAL}</td></tr></table>",
    "comments": f"<article class='post'>{{}}<div class='ad-slot'><p>{BUY}</p></div></article><ol class='commentlist'><li><article class='comment'>"
                f"<p>{SAID}</p><p>{SAID * 4}</p></article></li></ol><form><label>Name</label><input><textarea>{BUY}</textarea><button>Send</button></form>",
    "role": f"<div role=banner>Page</div><div role=navigation>{MENU}</div><div role=main>{{}}<form action=x><p>{BUY}</p></form></div>"
            f"<div role=contentinfo>{LEGAL}</div><div hidden>{BUY}</div><div style='display: none'>{BUY}</div>",
    "whole form": f"<form id=aspnet><div class='menu'>{MENU}</div><div id=story>{{}}</div><div class=foot-er>{LEGAL}</div></form>",
    "upper case": f"<DIV CLASS='Nav'>{MENU}</DIV><ARTICLE>{{}}</ARTICLE><FOOTER>{LEGAL}</FOOTER>",
    "mixed words": f"<div class='mainMenu'>{MENU}</div><div class='has-sidebar postBody'>{{}}</div><div class='relatedLinks'>{MENU}<p>{BUY}</p></div>",
}


def article(draw):
    words = "the river over stone and light comes home again with (small) boats \"quoted\" a<b x&y naïve café 東京".split()
    sentence = lambda n: " ".join(draw.choice(words) for _ in range(n)).capitalize() + "."
    return [sentence(6)] + [sentence(draw.choice((40, 60, 90))) for _ in range(2)] + [
        sentence(draw.choice((1, 2, 5, 30, 80))) for _ in range(draw.randrange(1, 8))] + [sentence(40)]


def escaped(text):
    return text.replace("&", "&amp;").replace("<", "&lt;").replace('"', "&quot;").replace("é", "&eacute;").replace("ï", "&#239;")


def marked(blocks, draw):
    """The blocks as markup: a heading, then paragraphs, some of them left open or with markup within."""
    out = [f"<h1 class='headline'>{escaped(blocks[0])}</h1>"]
    for b in blocks[1:]:
        kind = draw.randrange(4)
        words = escaped(b).split(" ")
        if kind == 0 and len(words) > 3:
            words[1], words[2] = f"<b>{words[1]}</b>", f"<a href='/x?a=1&amp;b=2' title='a > b'>{words[2]}</a><!-- <p>no</p> -->"
        text = (" ", "\n   ", "<br>", "\t")[kind].join(words)
        out.append(f"<p>{text}" + ("</p>\n" if kind != 1 else ""))
    return "".join(out)


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("seed", range(12))
def test_layouts(layout, seed):
    draw = random.Random(seed)
    blocks = article(draw)
    page = (f"<!DOCTYPE html><html><head><title>{escaped(blocks[0])}</title><style>p{{}}</style><script>var a='</p><p>{BUY}</p>';</script></head>"
            f"<body>{LAYOUTS[layout].format(marked(blocks, draw))}<noscript>{BUY}</noscript><script>track('{BUY}')</script></body></html>")
    assert main_text.extract(page).split("\n") == blocks


def test_surge_and_dive():
    line = lambda n, parent, plain=None: main_text.Line("x" * n, n if plain is None else plain, parent, None, None, False)
    menu, text, legal = [line(9, 1, 0)] * 6, [line(200, 2), line(2, 2), line(150, 2), line(90, 2), line(3, 2)], [line(9, 3, 0)] * 4
    assert main_text.between(menu + text + legal) == text
    assert main_text.between(legal + text) == text and main_text.between([]) == [] and main_text.between(menu) == []


@pytest.mark.parametrize("page, text", [
    ("", ""), ("just text", "just text"), ("<p>", ""), ("<p>a<p>b", "a\nb"), ("a < b & c &lt;d&gt; &nbsp;e", "a < b & c <d> e"),
    ("<article>one <b>two</article>", "one two"), ("<article><p>cut off here <b", "cut off here"), ("<article>a<script>x", "a"),
    ("<article>a<!-- never closed <p>b", "a"), ("<div class=ad>only this is here</div>", "only this is here"),
    ("<article><header><h1>Title</h1><p>by A</p></header><p>Text</p></article>", "Title\nText"),
    ("<article>x&#x41;&#65;&AMP;&amp &bogus;</article>", "xAA&& &bogus;"), ("</p></div><p>stray ends</p></article>", "stray ends"),
    ("<article><p title=\"it's > here\">quotes</p><p title='open>rest</p></article>", "quotes\nrest"),
])
def test_small_pages(page, text):
    assert main_text.extract(page) == text


def test_long_page_is_whole_and_quick():
    blocks = [f"paragraph {i} of a very long page with some words in it" for i in range(60_000)]
    page = "<nav>menu</nav><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    assert main_text.extract(page) == "\n".join(blocks)
    assert main_text.extract("<p title='" * 3000 + "x") is not None


def test_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article>é\U0001F600</article>"), (2, "v", " ")]
    pages = spark.createDataFrame([(*r, 5, "t") for r in rows], "page_id long, url string, html string, n_chars int, `TEXT` string")
    got = sorted(main_text.main_text(pages).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "é\U0001F600", 2), (2, "v", "", 0)], key=str)
    assert main_text.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    assert compare.mismatch(QUERIES["op13_main_text"](spark, folder), compare.duck(folder), SQL["op13_main_text"]) is None
