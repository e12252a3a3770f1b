"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, in page order. Lines inside
menus, page headers and footers, sidebars, notices, adverts, forms and reader
comments are left out, told by element, role, or a class or id that says nothing else
(never on a heading); text before and after them is adjacent. A line's weight is
the length of its text outside links. Lines of a marked article (``<article>`` or
``<main>``) weigh their whole text. Only where such articles hold more than half of
the page's text outside links, lines outside them are left out, too; all lines that
remain weigh something then, so the mark and not the sums bounds the text of such a
page. Weights are summed over a sliding window of ``WINDOW``
lines. A run of text goes on until a whole window weighs nothing (the dive); it
has a surge where a sum reaches the page's threshold. Every line from the first
run with a surge to the end of the last is kept, in order, also lines wholly of
links and short ones.

Defined cases: a null or empty page gives an empty text; broken or cut-off
markup is read as far as it goes; a page without markup is one line; character
references are decoded once, each within its piece of text; white space inside a line becomes one space. Long
pages are read whole, in time linear in their length. Extra columns are ignored
and repeated rows are each answered.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80

# Element and attribute names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
RAW_TAGS = frozenset("script style noscript template title textarea iframe svg object canvas select button noframes".split())
SKIP_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
SKIP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side-bar menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices alert popup modal overlay "
    "comment comments disqus reply replies respond share sharing social newsletter subscribe subscription related recommended "
    "widget toolbar pagination pager login signup search".split()
)
# Words that say where a box is or what it holds, beside a word of SKIP_WORDS.
PLACE_WORDS = frozenset(
    "area bar block bottom box button buttons col column container cookie fixed form global icon icons inner item items left link links "
    "list main mobile outer page panel primary reader right secondary section site slot sticky top unit user wrap wrapper "
    "articles posts stories".split()
)
# Words of the text itself: its comments and adverts are unwanted, its header is its title.
OWN_WORDS = frozenset("article entry post story".split())
TITLE_WORDS = frozenset("header banner masthead".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/<>]*)(?P<attrs2>[^<>]*)>""",
    re.S,
)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _unwanted_name(name: str) -> bool:
    """Whether a class or id names something unwanted: by itself, or together with words of place only.

    So ad-box, site_header and post-comments are unwanted; shadow, related-work
    and entry-header are not.
    """
    if name in SKIP_WORDS:
        return True
    parts = [p for p in re.split(r"[-_0-9]+", name) if p]
    skip = SKIP_WORDS.intersection(parts)
    place = PLACE_WORDS if skip & TITLE_WORDS else PLACE_WORDS | OWN_WORDS
    return bool(skip) and all(p in skip or p in place for p in parts)


def _unwanted(tag: str, attrs: str) -> bool:
    if tag in SKIP_TAGS:
        return True
    if not attrs or tag in ("html", "body", "a") or tag in HEADINGS:
        return False
    for name, value in _ATTR.findall(attrs):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            if value in SKIP_ROLES:
                return True
        elif any(_unwanted_name(n) for n in value.split()):
            return True
    return False


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, characters outside links, inside the article) of each block, unwanted ones with weight -1."""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = 0
    skip: list[str] = []  # open elements since the unwanted one, of its own name only
    links = article = 0
    at, end = 0, len(page)

    def flush():
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                lines.append((text, -1 if skip else max(len(text) - linked, 0), article > 0))
            parts.clear()
        linked = 0

    def text(s):
        nonlocal linked
        if s:
            s = html.unescape(s)  # a reference does not go on over a tag
            parts.append(s)
            if links:
                linked += len(s)

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        closing = m["end"] or m["end2"]
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in RAW_TAGS:
            if not closing and not attrs.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else (end if tag in ("script", "style") else at)
                parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCK_TAGS or skip:
            if tag in BLOCK_TAGS:
                flush()
        if tag in VOID_TAGS:
            continue
        if closing:
            if skip and tag == skip[0]:
                skip.pop()
            elif tag in ("body", "html", "article", "main"):
                skip.clear()  # whatever was unwanted ends with what holds it
                if tag in ("article", "main"):
                    article = max(article - 1, 0)
        elif skip:
            if tag == skip[0]:
                skip.append(tag)
            elif tag in ("article", "main") and not _unwanted(tag, attrs):
                skip.clear()  # the unwanted element was never closed
                article += 1
        elif not attrs.rstrip().endswith("/") and _unwanted(tag, attrs):
            flush()
            skip.append(tag)
        elif tag in ("article", "main"):
            article += 1
    flush()
    return lines


def _extent(weights: list[int]) -> tuple[int, int]:
    """First line of the first run with a surge, and one past the last line of the last."""
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    surge = min(SURGE, max(sums, default=0))
    first, last = len(weights), 0
    begin = end = 0
    high = 0  # highest sum of the run begin:end
    for i, weight in enumerate(weights):
        if weight:
            if i - end >= WINDOW:  # a window of nothing: the dive
                begin, high = i, 0
            elif not high:
                begin = i
            high, end = max(high, sums[i]), i + 1
            if high >= surge:
                first, last = min(first, begin), end
    return first, last


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = [line for line in page_lines(page) if line[1] >= 0]
    marked = sum(weight for _, weight, inside in lines if inside)
    if 2 * marked > sum(weight for _, weight, _ in lines):
        lines = [line for line in lines if line[2]]
    first, last = _extent([len(text) if inside else weight for text, weight, inside in lines])
    return "\n".join(text for text, _, _ in lines[first:last])


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    out = pages.select("page_id", "url", text(F.coalesce(F.col(html_col).cast("string"), F.lit(""))).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
