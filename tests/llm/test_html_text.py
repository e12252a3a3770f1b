import html
import re

from meterflow.llm.html_text import extract_pages, main_text

from .util import SF


def test_pages_against_their_own_structure(spark):
    """The generator wraps the main text in <article> with h1 and p."""
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in extract_pages(rows).collect()}
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id] == (want, len(want))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, a long enough notice to look like text, and then some more of it.</div>
%s<h2>Title &amp; more</h2><p>First   paragraph &lt;b&gt; with
 a break<br>and <a href=x>a link</a>.</p><p>Short.</p>
<script>var x = "<p>no</p>";</script><ul><li>one</li><li>two</li></ul><form><input><p>Sign up to our newsletter please, it is free of charge.</p></form>
<p>Last paragraph, long enough to count as text on any page that has no article element at all.</p>%s
<div id="comments"><p>A reader says that this text was very long and very good indeed, thanks a lot for it.</p></div>
<aside><p>Sidebar text that is also long, long enough to be mistaken for the main text of the page.</p></aside>
<footer><p>&copy; someone, with an address, a telephone number and all of the other usual things.</p></footer></body></html>"""
TEXT = "Title & more\nFirst paragraph <b> with a break and a link.\nShort.\none\ntwo\nLast paragraph, long enough to count as text on any page that has no article element at all."


def test_with_and_without_an_article_element():
    assert main_text(PAGE % ("<article>", "</article>")) == TEXT
    assert main_text(PAGE % ("<main>", "</main>")) == TEXT
    assert main_text(PAGE % ("<div>", "</div>")) == TEXT


LONG = "<p>" + "A long paragraph of the text. " * 7 + "</p>"
TOLD = ("A long paragraph of the text. " * 7).strip()


def test_text_goes_on_after_unwanted_lines_and_links():
    for cut in ("<div class=ad>Buy this now.</div>", "<aside><p>Other</p><p>things</p><p>to</p><p>read</p></aside>", "<form><p>Sign up.</p></form>", "<div class=notice>" + "<p>We use cookies.</p>" * 9 + "</div>"):
        assert main_text(LONG + cut + "<p>The end of it.</p>") == TOLD + "\nThe end of it."
        assert main_text("<p>It begins.</p>" + cut + LONG) == "It begins.\n" + TOLD
    assert main_text(LONG + "<p><a href=x>Wholly a link</a></p><p>The end.</p>") == TOLD + "\nWholly a link\nThe end."
    links = "<ul>" + "<li><a href=x>more</a></li>" * 5 + "</ul>"
    assert main_text(LONG + links + "<p>Short.</p>" + links + LONG) == "\n".join([TOLD, *["more"] * 5, "Short.", *["more"] * 5, TOLD])
    assert main_text("<p>Menu</p>" + links + LONG + "<p>End.</p>" + links + "<p>Imprint</p>") == TOLD + "\nEnd."
    assert main_text(links) == ""


def test_an_article_element_that_is_not_the_main_text():
    links = "<ul>" + "<li><a href=x>more</a></li>" * 5 + "</ul>"
    teaser = "<article><h3>Related</h3><p>Another story.</p></article>"
    content = "<div id=content><h1>Title</h1>" + LONG * 3 + "<p>End.</p></div>"
    text = "\n".join(["Title", *[TOLD] * 3, "End."])
    assert main_text(content + links + teaser) == text
    assert main_text(teaser + links + content) == text
    # Links do not make a teaser the main text, however many there are.
    many = "<article><p><a href=x>" + "A linked headline. " * 3 + "</a></p></article>"
    assert text in main_text(content + many * 20)
    # A surge outside the text is not kept where the mark holds most of it.
    assert main_text(LONG + links + "<article><h1>Title</h1>" + LONG * 3 + "<p>End.</p></article>" + links + LONG) == text
    # Each of many articles is kept, short ones too.
    posts = [TOLD * 2, "Thanks!", "Ok.", TOLD, "Bye."]
    assert main_text(links.join(f"<article><p>{p}</p></article>" for p in posts)) == "\n".join(posts)
    # Links of an article are its text.
    assert main_text("<article>" + links + "</article>") == "\n".join(["more"] * 5)


def test_names_that_only_hold_an_unwanted_word():
    for kept in (
        '<section id="related-work"><h2 id="related-work">Related work</h2><p>Others did this before.</p></section>',
        '<div class="entry-header"><h2 id="search">Search</h2></div><p class="comment-on-method">A note.</p>',
        '<div class="cookie-recipes"><p>Take some flour.</p></div>',
    ):
        lines = [re.sub(r"<[^>]*>", "", x) for x in re.findall(r"<(?:p|h2)[^>]*>[^<]*", kept)]
        assert main_text(LONG + kept + LONG) == "\n".join([TOLD, *lines, TOLD])
    for name in ("ad", "ad-box", "ad_slot_3", "site-header", "cookie-banner", "post-comments", "related-posts", "side-bar", "share-buttons", "newsletter"):
        for tag in ("div", "section"):
            assert main_text(f'{LONG}<{tag} class="x1 {name}"><p>Not of the text.</p></{tag}>{LONG}') == TOLD + "\n" + TOLD


def test_references_and_formulas():
    assert main_text("<p>&am<b>p;x</b> &amp;lt; 1&nbsp;&#x32;</p>") == "&amp;x &lt; 1 2"
    assert main_text("<p>where <math><mi>x</mi><mo>&lt;</mo><mn>2</mn></math> holds</p>") == "where x<2 holds"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<!-- x") == ""
    assert main_text("plain &eacute; text\n here") == "plain é text here"
    assert main_text("<article><p>cut off &amp") == "cut off &"
    assert main_text("<article><p>a < b and <c</p></article>") == "a < b and <c"
    assert main_text("<div class=ad>never closed<article><p>text</p></article>") == "text"
    assert main_text("<article><p>kept</p><article class='comment'><p>not kept</p></article><p>kept too</p></article>") == "kept\nkept too"
    assert main_text("<article>" + "<p>x</p>" * 50_000 + "</article>") == "\n".join(["x"] * 50_000)
    assert main_text("<a<a" * 50_000 + "<article>t</article>").endswith("t")


def test_nulls_repeats_and_empty_table(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "x"), (1, None, None, "x", "x"), (None, "u", "<p>hello</p>", "x", "x")]
    got = sorted((tuple(r) for r in extract_pages(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == [(1, None, "", 0), (1, None, "", 0), (None, "u", "hello", 5)]
    assert extract_pages(spark.createDataFrame([], schema)).collect() == []
