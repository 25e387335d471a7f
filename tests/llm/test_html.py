"""Main text of pages."""

import time

import pytest

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import html

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><h1>Site</h1></header><div id="menu"><a href="#">a</a></div><nav><ul><li><a href="/x">x</a></li></ul></nav>
<main><article><header><h1>The title</h1></header><div class="content"><p>First, a paragraph of text with
 <a href="x">a link</a>, and <b>more words<br>in it.</p><p>Second &amp; last&nbsp;one, with enough &lt;words&gt;.</p>
<form><label>Mail</label></form><div class="share-box">Share this</div><ul class="related"><li><a>r</a></li></ul></div></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I, for one, like this very much, it is a long comment, really,
with commas, yes, and commas, and commas.</p></div></section></main>
<aside>Side, bar</aside><div class="cookie-notice">We use cookies</div><footer>&copy; foot</footer></body></html>"""


def test_article_only():
    want = ["The title", "First, a paragraph of text with a link, and more words in it.", "Second & last one, with enough <words>."]
    assert html.main_text(PAGE) == "\n\n".join(want)


def test_container_without_article():
    page = (
        '<body><div class="top"><a>Home</a> <a>News</a> <a>More</a></div><div><p>One sentence, long enough to count as prose.</p>'
        "<p>Another sentence, long enough to count, too.</p></div><div><ul><li><a>l1</a></li><li><a>l2</a></li></ul></div></body>"
    )
    assert html.main_text(page) == "One sentence, long enough to count as prose.\n\nAnother sentence, long enough to count, too."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("<p", ""),
        ("<script>x", ""),
        ("<article><p>a &am", "a &am"),
        ("<div>a, b<p>c d &lt; e</div>", "a, b\n\nc d < e"),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<body><h1>T</h1><div><p>Hi.</p></div>", "T\n\nHi."),
        ("<article><p hidden>no</p><p style='display:none'>no</p><!-- <p>no</p> --><p title='a>b'>yes</p></article>", "yes"),
    ],
)
def test_odd_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "start",
    ["<head><title>t</title><body>", "<head><meta charset=x><script>1</script>\n", "<head></head><body>", "<head><link rel=x></head>", ""],
)
def test_head_left_open(start):
    assert html.main_text(f"<html>{start}<article><p>text, more text.</p></article>") == "text, more text."
    assert html.main_text(f"<html>{start}text") == "text"


PROSE = "One sentence, long enough to count as prose, and another one, as long."


@pytest.mark.parametrize(
    "attributes",
    [
        "class='layout has-sidebar'",
        "class='main overflow-hidden'",
        "class='page no-sidebar'",
        "class='content with-related'",
        "id='search-result-page'",
        "class='has-header'",
        "title='The hidden garden'",
        "data-hidden='false'",
        "data-id='search-3'",
        "data-class=ad",
        "class='search'",
        "id=header",
        "class='sidebar widget-area'",
    ],
)
def test_names_alone_drop_no_article(attributes):
    aside = "<div class='left-sidebar'>Beside</div><div class=related><article>Card</article></div>"
    for inner in (f"<article><p>{PROSE}</p></article>", f"<main><p>{PROSE}</p></main>", f"<p>{PROSE}</p>"):
        assert html.main_text(f"<body>{aside}<div {attributes}>{inner}</div></body>") == PROSE
    assert html.main_text(f"<body><article><div {attributes}><p>{PROSE}</p></div>{aside}</article></body>") == PROSE


@pytest.mark.parametrize("attributes", ["class='x share-box'", "id=cookie-notice", "CLASS=siteFooter", "hidden", "role='search'", "class='ad-300x250'"])
def test_junk_beside_the_article(attributes):
    page = f"<main><article><p>{PROSE}</p><div {attributes}>Some more, which is junk.</div></article></main>"
    assert html.main_text(page) == PROSE


def test_deep_and_long_pages():
    assert html.main_text("<div>" * 3000 + "deep text" + "</div>" * 3000) == "deep text"
    long = "<article>" + "<p>word, word and word again here</p>" * 20_000 + "</article>"
    assert html.main_text(long).count("\n\n") == 19_999


def test_extract(frame):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "v", "<article><p>é😀</p></article>", None)]
    pages = frame(rows, "page_id long, url string, html string, n_links string")
    got = html.extract(pages).collect()
    assert len(got) == 4 and {r["n_chars"] for r in got if r["page_id"] == 3} == {2}
    assert all(r["text"] == "" for r in got if r["page_id"] == 2)
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "x, y",
        "<b>x" * 100_000,
        "<div>x, y" * 100_000,
        "<div>" * 100_000 + "</section></i>" * 100_000,
        "<div>" * 100_000 + "<td>a</td>" * 100_000,
        "<article><div class=ad>x, y" * 50_000,
    ],
    ids=["deep", "inline", "texts", "stray ends", "cells", "stories"],
)
def test_time_is_linear(page):
    start = time.monotonic()
    html.main_text(page)
    assert time.monotonic() - start < 10


def test_links_of_an_article_stay():
    links = "<ul><li><a>first reference</a></li><li><a>second reference</a></li></ul>"
    assert html.main_text(f"<article><p>{PROSE}</p>{links}</article>") == f"{PROSE}\n\nfirst reference\n\nsecond reference"
    long = f"<p>{PROSE} {PROSE}</p>"
    between = html.main_text(f"<body><div>{long}{links}{long}</div><div><ul><li><a>menu</a></li></ul></div></body>")
    assert between == f"{PROSE} {PROSE}\n\nfirst reference\n\nsecond reference\n\n{PROSE} {PROSE}"
    assert html.main_text(f"<body><div>{long}{links}</div></body>") == f"{PROSE} {PROSE}"


def plain_main(page: html.Page) -> list[str]:
    """The method by sets of ancestors and sums over all blocks, for every element anew."""
    def above(element):
        return [] if element <= 0 else [element, *above(page.parent[element])]

    paths = [above(e) for e, _ in page.blocks]
    size = range(1, len(page.tag))
    text = {e: sum(len(t) for (_, t), path in zip(page.blocks, paths) if e in path) for e in size}
    points = dict.fromkeys(size, 0.0)
    for (element, block), path in zip(page.blocks, paths):
        worth = min(len(block) / 100, 3.0) + block.count(",") + (1.0 if len(block) >= 25 else 0.1)
        if page.tag[element] in ("p", "pre", "li", "td", "blockquote", *html.HEADINGS):
            path = path[1:]
        for n, e in enumerate(path[:5]):
            points[e] += worth * (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12)[n]
    density = {e: page.links[e] / text[e] if text[e] else 0.0 for e in size}
    score = {e: points[e] * (0.5 if e in page.lowered else 1) * (1 - density[e]) for e in size}
    prose = {e for e in size if page.tag[e] == "p" and text[e] >= 80 and density[e] < 0.25}
    able = [e for e in size if page.tag[e] not in ("html", "p", "li", "td", "th", *html.HEADINGS)]
    best = max(able, key=lambda e: (round(score[e], 9), -e), default=0)
    if not best or score[best] <= 0:
        return [t for _, t in page.blocks]
    best = next((e for e in above(best) if page.tag[e] in ("article", "main")), best)
    kept = {best}
    for e in size:
        if page.tag[best] not in ("body", "main") and e != best and page.parent[e] == page.parent[best]:
            good = score[e] >= 0.2 * score[best] > 0 and page.tag[e] not in html.HEADINGS
            if good or e in prose or (page.tag[e] in ("h1", "h2") and text[e] and e < best):
                kept.add(e)
    chosen = [e for e in prose if best in above(e)]
    dropped = set()
    for e in size:
        if page.tag[e] in ("ul", "ol", "table", "div", "section") and density[e] > 0.8:
            inside = {x for x in size if e in above(x)}
            between = chosen and min(chosen) < e and max(inside) < max(chosen)
            article = any(page.tag[x] == "article" for x in above(e))
            if best not in above(e) or not (article or between):
                dropped.add(e)
    return [t for (_, t), path in zip(page.blocks, paths) if kept & set(path) and not dropped & set(path)]


def test_plain_version_over_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    assert rows
    for (source,) in rows:
        if source:
            assert html.main_text(source) == "\n\n".join(plain_main(html.Page(source)))
