"""Operator 13: main text of HTML pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each block of text; what markup itself declares to be a menu, a
footer, an advert, a form, reader comments or the like leaves no line. Text lengths (links apart) are summed over
windows of a few lines. The window with most text lies in the article; from there the text runs back to
the line where the sums surge and on to the line where they dive. An ``article`` or ``main``
element around that window, where a page has one, states the same two points itself.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import pick, raw, steps

#: Lines of a window, and the characters in a window at which the text surges (less for a short article).
WINDOW, SURGE = 3, 86

# Elements of HTML by their role, and words by which pages name what is not the article.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead title tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
GONE = frozenset("aside audio button canvas datalist dialog embed footer form head iframe input menu nav noscript object option "
                 "script search select style svg template textarea title video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
SCOPES = frozenset("ul ol dl table td th body article section div main aside nav header footer form blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit sponsor sponsored sponsors promo "
    "promos promotion promoted banner banners cookie cookies cookiebar consent gdpr notice notices notification notifications "
    "alert alerts popup modal overlay interstitial paywall newsletter subscribe subscription signup signin login register sidebar "
    "sidebars sidenav rail menu menus menubar submenu dropdown nav navs navbar navigation breadcrumb breadcrumbs crumbs footer "
    "footers colophon comment comments commentlist commentform disqus replies reply respond share sharing sharebar social related "
    "recommended recommendations widget widgets toolbar pagination pager searchbox searchform search copyright disclaimer".split())
HEADER = frozenset("header masthead topbar".split())
NEGATED = frozenset("has no not with without non hide is".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]{0,8192}+\"|'[^']{0,8192}+')*+>|[^>]*(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_LEGAL = re.compile(r"(?:©|\(c\)\s|copyright\b)", re.I)

KEEP, ONLY_HEADINGS, DROP = range(3)


@dataclass
class Line:
    """A block of text, the number of its characters outside links, and where it stands."""

    text: str
    plain: int
    parent: int
    article: int | None
    main: int | None
    heading: bool


def _names(value: str) -> bool | None:
    """What the words of a class or id say: True for not the article, None for a header, else False."""
    found: bool | None = False
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        for before, word in zip([""] + words, words):
            if before not in NEGATED:
                if word in NOT_ARTICLE:
                    return True
                if word in HEADER:
                    found = None
    return found


@lru_cache(maxsize=4096)
def _declared(tag: str, attributes: str, names: bool) -> tuple[int, bool]:
    """How an element treats the text in it, and whether its attributes call it the article."""
    found = {a.lower(): html.unescape(x or y or z) for a, x, y, z in _ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower()
    body = role in ("main", "article") or "articlebody" in found.get("itemprop", "").lower()
    if tag in GONE or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or role in ROLES:
        return DROP, body
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return DROP, body
    mode = ONLY_HEADINGS if tag == "header" else KEEP
    if names and not body and tag not in ("html", "body", "main"):
        said = [_names(found.get(a, "")) for a in ("class", "id")]
        if True in said:
            return DROP, body
        if None in said and tag not in HEADINGS:
            mode = ONLY_HEADINGS
    return mode, body


def lines(page: str, names: bool = True, forms: bool = True) -> list[Line]:
    """The page's blocks of text in order, without what its markup declares not to be the article.

    ``names`` heeds classes and ids; ``forms`` drops forms, which some pages put around everything.
    """
    out: list[Line] = []
    # An element: name, mode, number, enclosing article, enclosing main, whether in a link, in a heading.
    stack: list[tuple] = [("", KEEP, 0, None, None, False, False)]
    parts: list[str] = []
    plain = number = 0

    def flush() -> None:
        nonlocal plain
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                at = next(e for e in reversed(stack) if e[0] in BLOCKS or not e[0])
                # A line's parent is the block around its own block, which sibling lines share.
                around = stack[stack.index(at) - 1] if at[0] else at
                out.append(Line(text, plain, around[2], at[3], at[4], at[6]))
        plain = 0

    def take(text: str) -> None:
        nonlocal plain
        _, mode, _, _, _, link, heading = stack[-1]
        if mode == KEEP or (mode == ONLY_HEADINGS and heading):
            text = html.unescape(text)
            parts.append(text)
            if not link:
                plain += len(text) - text.count(" ")

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1][0] in BLOCKS:
                flush()
            stack.pop()

    at = 0
    while tag := _TAG.search(page, at):
        if tag.start() > at:
            take(page[at:tag.start()])
        at = tag.end()
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        if tag.group(1):
            if name == "p" or name == "br":
                flush()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                close(depth)
            continue
        attributes = tag.group(3)
        if name in BLOCKS:
            flush()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "p"), 0)
            if depth:
                close(depth)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in CLOSES.get(name, ()):
                    close(i)
                elif stack[i][0] in SCOPES:
                    break
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
        if name == "br":
            parts.append(" ")
            continue
        if name in VOID or attributes.rstrip(">").endswith("/") and name not in BLOCKS:
            continue
        _, mode, _, article, main, link, heading = stack[-1]
        own, body = _declared(name, attributes.rstrip(">"), names)
        if name == "form" and not forms:
            own = KEEP
        number += 1
        inside = article is not None or main is not None
        if own == ONLY_HEADINGS and not inside:
            own = DROP  # a header of the page, not of its article
        mode = max(mode, own)
        if mode < DROP:
            if (name == "article" or body) and article is None:
                article = number
            elif name == "main" and main is None:
                main = number
        stack.append((name, mode, number, article, main, link or name == "a", heading or name in HEADINGS))
    if at < len(page):
        take(page[at:])
    flush()
    return out


def between(found: list[Line], window: int = WINDOW, surge: int = SURGE) -> list[Line]:
    """The lines from the surge before the window with most text to the dive after it."""
    if not found:
        return []
    sizes = [x.plain for x in found]
    sums = [sum(sizes[i:i + window]) for i in range(len(sizes))]
    top = max(range(len(sums)), key=sums.__getitem__)
    longest = max(range(top, min(top + window, len(sizes))), key=sizes.__getitem__)
    for field in ("article", "main"):
        around = getattr(found[longest], field)
        if around is not None:
            return [x for x in found if getattr(x, field) == around]
    if not sums[top]:
        return []
    least = min(surge, sums[top] // 2)
    first = last = longest
    while first and sum(sizes[max(0, first - window):first]) > least:
        first -= 1
    while last + 1 < len(sizes) and sum(sizes[last + 1:last + 1 + window]) > least:
        last += 1
    # Short lines beside the text belong to it where they share its parent or head it; links alone don't.
    parents = {x.parent for x in found[first:last + 1] if x.plain}
    while first and found[first - 1].plain and (found[first - 1].parent in parents or found[first - 1].heading):
        first -= 1
    while last + 1 < len(sizes) and found[last + 1].plain and found[last + 1].parent in parents:
        last += 1
    while first < last and not sizes[first]:
        first += 1
    while last > first and (not sizes[last] or _LEGAL.match(found[last].text)):
        last -= 1
    return found[first:last + 1]


def extract(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """Main text of a page, blocks joined by a line end. Declarations that leave nothing at all are not believed."""
    for names, forms in ((True, True), (True, False), (False, False)):
        kept = between(lines(page, names, forms), window, surge)
        if kept:
            return "\n".join(x.text for x in kept)
    return ""


def main_text(pages: DataFrame, *, window: int = WINDOW, surge: int = SURGE, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """page_id, url, ``text`` (blocks of the article, joined by a line end) and ``n_chars`` (its code points) of each row.

    Whole pages are read in one pass; white space within a block is one space, and character references are
    decoded. A NULL or empty page, or one without any text, has the empty text. Ids and urls are handed on
    as they are, NULL and repeated ones too; an empty table gives an empty result.
    """
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            texts = [extract(t.decode("utf-8", "replace"), window, surge) for t in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return rows.withColumn("html", raw("html")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
