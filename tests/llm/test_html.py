import html as entities
import re

import pytest

from timeloom.llm.html import extract, extract_text

PROSE = "A sentence of the article, with commas and a full stop; it goes on for a while. " * 3


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


def test_boilerplate_goes_and_the_article_stays():
    body = (f"<header class='site'><a href='/'>Home</a></header><nav><ul><li><a href='/a'>Menu</a></ul></nav>"
            f"<div class='cookie-notice'>We use cookies, as you know. {PROSE}</div><aside><p>{PROSE}</p></aside>"
            f"<main><article><header><h1>Title &amp; more</h1></header><p>First &lt;b&gt;\n  block.<br>Same block.</p><p>{PROSE}"
            f"<p>Short.<ul><li>one<li>two</ul><div class='share-bar'><a href='#'>Share</a></div><!-- hidden --><form>Search <input></form>"
            f"<blockquote>Quote, {PROSE}</blockquote></article></main><section id='comments'><p>{PROSE}</p></section>"
            f"<div class='userComments'>{PROSE}</div><footer>&copy; me</footer>")
    assert extract_text(page(body)).split("\n") == [
        "Title & more", "First <b> block. Same block.", PROSE.strip(), "Short.", "one", "two", f"Quote, {PROSE}".strip()]


def test_pages_without_an_article_element():
    body = (f"<div id='top'><a href='/'>Home</a> <a href='/b'>News</a></div><div id='page'><h1>Head</h1><div class='text'><p>{PROSE}</p>"
            f"<p>Tiny.</p><p>{PROSE}</p></div></div><div class='sidebar'><p>{PROSE}</p></div>")
    assert extract_text(page(body)).split("\n") == ["Head", PROSE.strip(), "Tiny.", PROSE.strip()]


def test_broken_and_empty_markup():
    assert extract_text("") == "" and extract_text("<html><body></body></html>") == ""
    assert extract_text("just text, no markup.") == "just text, no markup."
    assert extract_text(f"<article><p>{PROSE}<p>cut off <a href='x").startswith(PROSE.strip())
    assert extract_text("<article><p>&am &amp &#65; &nosuch; &nbsp;x</article>") == "&am & A &nosuch; x"


def test_table_against_the_article_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html or "", re.S)
        blocks = re.split(r"</?(?:p|h1)[^>]*>", inner.group(1) if inner else "")
        plain = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
        assert got[r.page_id] == "\n".join(b for b in plain if b)


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", "x"), (2, "v", "<p>" + "long " * 50_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, len(r.text)) for r in extract(df).collect()) == [(0, 0), (1, 0), (1, 0), (2, 249_999)]
    assert extract(df.limit(0)).columns == ["page_id", "url", "text"] and extract(df.limit(0)).count() == 0


BODY = "".join(f"<p>Sentence {i}, with some words and more of them. Another one follows here, as it should.</p>" for i in range(6))
TEXT = "\n".join(f"Sentence {i}, with some words and more of them. Another one follows here, as it should." for i in range(6))


@pytest.mark.parametrize("attr", ['class="content has-sidebar"', 'class="no-comments"', 'class="elementor-widget-container"', 'class="layout-with-nav"',
                                  'class="social-science-article"', 'class="post ad-free"', 'id="search-result-article"'])
def test_wrappers_named_like_boilerplate(attr):
    page = f'<body><nav><a href="/">Home</a></nav><div {attr}>{BODY}<div class="comments"><p>First, said a reader. Nice, very nice!</p></div></div><footer>Foot</footer>'
    assert extract_text(page) == TEXT


def test_page_in_a_form():
    page = f'<body><form id="aspnetForm"><nav><a href="/">Home</a></nav><article>{BODY}</article><div class="sidebar">Side</div></form></body>'
    assert extract_text(page) == TEXT
    assert extract_text(f'<body><div class="text">{BODY}</div><form><p>Your name, please. And your address, too.</p></form></body>') == TEXT


def test_single_links_of_the_article_stay():
    page = f'<body><article>{BODY}<ul><li><a href="x">The report</a></li></ul></article></body>'
    assert extract_text(page) == TEXT + "\nThe report"
    menu = "".join(f'<li><a href="{i}">Entry {i}</a></li>' for i in range(6))
    assert extract_text(f"<body><article>{BODY}<ul>{menu}</ul></article></body>") == TEXT


def test_article_comments_are_comments():
    page = f'<body><div class="post">{BODY}</div><div id="article-comments">{"<p>A reader says, well, this. And that!</p>" * 4}</div></body>'
    assert extract_text(page) == TEXT
