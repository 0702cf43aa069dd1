"""Main text of pages, hand-written and from the given table."""

from __future__ import annotations

import html as entities
import re

import pytest

from payrisk.llm.html import extract_pages, main_text
from tests.conftest import SF

LONG = "This is a sentence of the article that goes on for long enough to count as content. "


def test_query_equals_the_marked_article(spark, run_query):
    """In the given pages one element holds the article, which a pattern can read."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = run_query(1).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S).group(1)
        want = " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav><a href=x>Home</a></nav>", ""),
        ("plain  text\nonly", "plain text only"),
        ("<article><p>a &lt;b&gt; &amp; &eacute;&#33;<p>c</article>", "a <b> & é! c"),
        (f"<article><h1>T</h1><p>{LONG}<!-- no --><i>in</i>side</p><p>Hi.</article>", f"T {LONG}inside Hi."),
        (f"<article><p>{LONG}</p><div class=comments><p>{LONG}</p></div></article>", LONG.strip()),
        (f"<article><p>{LONG}</p><aside>{LONG}</aside><form>{LONG}</form></article>", LONG.strip()),
        (f"<div id=sidebar>{LONG * 3}</div><div class=post><p>{LONG}</p></div>", LONG.strip()),
        (f"<p class=x>{LONG}</p><div class='cookie-notice'>{LONG}</div>", LONG.strip()),
        (f"<header>{LONG}</header><main><p>{LONG}</p></main><footer>{LONG}</footer>", LONG.strip()),
        (f"<div class=ad><article><p>{LONG}</p></article>", LONG.strip()),
        (f"<article><p>{LONG}</p><script>if (a < b) x('<p>no</p>')</script><style>p{{}}</style>", LONG.strip()),
        (f"<article><p>{LONG}</p><p>cut <a hre", f"{LONG}cut"),
        (f"<article><h1>T</h1><p>Lead.</p><div class=body><p>{LONG * 3}</p></div></article>", f"T Lead. {LONG * 3}".strip()),
        (f"<div class=page><h1>T</h1><div class=body><p>{LONG}</p><p>{LONG}</p></div></div>", f"T {LONG}{LONG}".strip()),
    ],
)
def test_hand_written_pages(page, text):
    assert main_text(page) == text


PROSE = f"<p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>"
TEXT = " ".join([LONG.strip()] * 3)
SIDE = f"<div class=sidebar><p>{LONG}</p></div>"
LINKS = "<ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul>"


@pytest.mark.parametrize(
    "page",
    [
        # Wrappers that say what stands beside them, or have names that articles have too.
        f'<div class="content with-sidebar">{PROSE}</div>',
        f'<div class="content with-sidebar">{PROSE}{SIDE}</div>',
        f'<section class="has-sidebar"><article>{PROSE}</article>{SIDE}</section>',
        f'<div class=has-comments>{PROSE}<div class=comments><p>{LONG}</p></div></div>',
        f"<body>{LINKS}<div class=no-sidebar>{PROSE}</div></body>",
        f'<div id="legal-news">{PROSE}</div>',
        f"<div class=related-work>{PROSE}</div>{SIDE}",
        f"<section id=social-policy>{PROSE}</section><div class=footer>{LONG}</div>",
        f"<div class=discussion-paper>{PROSE}</div><nav>{LINKS}</nav>",
        f"<body>{LINKS}<div class=skip-target>{PROSE}</div></body>",
        # Named wrappers around the article.
        f"<div class=sidebar-layout><article>{PROSE}</article></div><div class=ad>{LONG}</div>",
        f"<div class=widget-page><main>{PROSE}</main></div><footer>{LONG}</footer>",
        f"<div class=modal-open><div class=page>{PROSE}</div></div>",
        f"<div id=page-banner-wrap>{LINKS}<div>{PROSE}</div><div class=comments><p>{LONG}</div></div>",
        f"<table class=search-result><tr><td>{PROSE}</td></tr></table>",
        f"<div class=notice-board><div class=text>{PROSE}</div></div><div class=cookie-notice>{LONG}</div>",
        # Real ones stay out.
        f"<div class=post>{PROSE}</div><div class=sidebar>{PROSE}{PROSE}</div>",
        f"<div class=post>{PROSE}</div><div class=comments>{PROSE}{PROSE}</div>",
        f"<body>{SIDE}<p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><div class=newsletter>{LONG}</div></body>",
        f"<main>{PROSE}<div class='ad banner'>{LONG}</div></main><div class=related-widget>{LONG}</div>",
        f"<header>{LONG}</header><div id=main-text>{PROSE}</div><div class=reply><h1>Re</h1>{LONG}</div>",
    ],
)
def test_pages_without_a_marked_article(page):
    assert main_text(page) == TEXT


def test_a_headed_data_table_stays():
    table = "<table class=header-table><tr><td>Year and amount of the first row here</td><td>12 and more of it</td></tr></table>"
    page = f"<main>{PROSE}{table}</main>"
    assert main_text(page) == f"{TEXT} Year and amount of the first row here 12 and more of it"


def test_articles_without_a_name_of_their_own():
    page = (
        "<body><ul><li><a href=a>One</a><li><a href=b>Two</a></ul><h1>Head</h1>"
        f"<p>{LONG}<p>{LONG}<p>Short.<p>{LONG}<table><tr><td><a href=x>link</a></table></body>"
    )
    assert main_text(page) == f"Head {LONG}{LONG}Short. {LONG}".strip()


def test_deep_and_long_pages_take_linear_time():
    assert main_text("<div>a " * 20_000 + "</x></p>" * 20_000).count("a") > 10_000
    assert main_text("<article>" + "<p>word <b>x" * 20_000).count("word") == 20_000


def test_odd_rows(spark):
    rows = [(1, None, "<p>a", "x"), (1, None, "<p>a", "x"), (None, "u", None, None), (2, "u", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_pages(pages)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(r["text"] for r in out.collect()) == ["", "", "a", "a"]
    assert extract_pages(pages.limit(0)).count() == 0
