"""Main text of pages: edge pages, and the driver's pages against their article element."""

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from rxtally.llm.html_text import extracted, main_text

PAGES = [
    (None, ""),
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one\n  two<p>three <i>four</i>", "one two\nthree four"),
    ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<div class='comments'><p>no</div><p>Yes &lt;b&gt; &#233;.</p>", "Yes <b> é."),
    ("<nav><a href=/>Home</a></nav><p>Text.</p><footer>Foot</footer>", "Text."),
    ("<p>Say <script>var t='</p>';</script>this.<!-- not > this --></p><style>p{}</style>", "Say this."),
    ("<p>cut <a href='x", "cut"),
    ("<b>" * 3000 + "deep", "deep"),
    ("<" * 50, "<" * 50),
    ("<p>" + "word " * 50_000, ("word " * 50_000).strip()),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_edge_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p title=Bob's>one two</p><p>three</p>", "one two\nthree"),
        ('<p class="a"">one</p><p>two</p><p class="b">three</p>', "one\ntwo\nthree"),
        ("<p title='>'>one</p><p title = \">\">two</p>", "one\ntwo"),
        ("<p title=\"never closed>one</p><p>two</p>", "one\ntwo"),
        ("<p \">one</p><p data=x=\"y>two</p><p>three", "one\ntwo\nthree"),
        ("<p>one<a title=\"cut", "one"),
    ],
)
def test_stray_quotes_lose_no_words(page, text):
    assert main_text(page) == text


def test_density_finds_unmarked_content():
    menu = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(30))
    paragraph = "A sentence with enough words to look like prose, and no link in it. " * 4
    body = f"<div><ul>{menu}</ul></div><div><h1>Head line</h1>{f'<p>{paragraph}</p>' * 5}</div><div><ul>{menu}</ul></div>"
    found = main_text(f"<html><body>{body}</body></html>")
    assert found == "\n".join(["Head line"] + [paragraph.strip()] * 5)


@pytest.mark.parametrize("outer", ["{}", "<main>{}</main>"])
def test_an_article_beside_the_main_text_does_not_replace_it(outer):
    """The same with the whole in a main element, where two elements are marked."""
    paragraph = "A sentence with enough words to look like prose, and no link in it. " * 4
    text = f"<div>{f'<p>{paragraph}</p>' * 6}</div>"
    teaser = f"<article><p>{'Read this other story, it is well worth the time. ' * 12}</p></article>"
    found = main_text(f"<html><body>{outer.format(text + teaser)}</body></html>").split("\n")
    assert found[:6] == [paragraph.strip()] * 6


def test_mark_widens_to_the_whole_article():
    paragraph = "A sentence with enough words to look like prose, and no link in it. " * 4
    inside = f"<h1>Head</h1><div>{f'<p>{paragraph}</p>' * 5}</div><p>End.</p>"
    lines = ["Head", *[paragraph.strip()] * 5, "End."]
    for page in (f"<article>{inside}</article>", f"<main><article>{inside}</article></main>"):
        assert main_text(f"<body><div><ul><li><a href=/>Home</a></ul></div>{page}</body>") == "\n".join(lines)


def test_driver_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("text", F.lit("clash"))
    rows = {r["page_id"]: r["html"] for r in pages.collect()}
    found = extracted(pages.drop("text"), "page_id", "url").collect()
    assert len(found) == len(rows)
    for r in found:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", rows[r["page_id"]], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", "", article))
        lines = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in parts]
        assert r["text"] == "\n".join(x for x in lines if x)
        assert r["n_chars"] == len(r["text"])


def test_empty_table(spark):
    frame = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extracted(frame, "page_id", "url").collect() == []


ARTICLE = "<h1>Title of it</h1><p>" + "A sentence with some words. " * 9 + "</p><p>" + "Another one of them here. " * 9 + "</p>"
LINES = "\n".join(["Title of it", ("A sentence with some words. " * 9).strip(), ("Another one of them here. " * 9).strip()])
MENU = "<nav><a href=x>One</a><a href=y>Two</a></nav><footer>Imprint and contact</footer>"


def test_wrapped_and_oddly_named_pages_keep_their_text():
    for page in [
        f"<body><form id=aspnetForm>{MENU}{ARTICLE}</form>",
        f"<body><form><div class=content>{ARTICLE}</div><div class=comments><p>First!</p><p>Me too, reader.</p></div></form>",
        f"<body><div id=widget>{MENU}{ARTICLE}</div>",
        f"<body>{MENU}<div style='overflow:hidden'>{ARTICLE}</div>",
        f"<body>{MENU}<div title='hidden gems' aria-hidden='false' data-id=share data-class='ad'>{ARTICLE}</div>",
        f"<body>{MENU}<div class='related-work'>{ARTICLE}</div>",
        f"<body><div class=sidebar>{MENU}<main>{ARTICLE}</main></div>",
    ]:
        assert main_text(page) == LINES, page
    for cut in ["<div hidden>", "<div class='post-comments'>", "<div id=cookie-notice>", "<form>", "<div role=banner>", "<aside>"]:
        assert main_text(f"<body>{ARTICLE}{cut}<p>not this</p></body>") == LINES, cut


def test_unbalanced_pages_take_time_by_their_length():
    start = time.perf_counter()
    for piece in ("<b></i>", "<b><p></p>", "<ul><li><b>", "<div><b></p>", "<li><ul>", "<tr><td>", "<form><nav>"):
        main_text(piece * 60_000)
    assert time.perf_counter() - start < 60


def test_repeated_rows_and_null_ids(spark):
    page = f"<body>{ARTICLE}"
    frame = spark.createDataFrame([(1, page), (1, page), (None, page), (2, None)], "page_id bigint, html string")
    found = sorted(map(tuple, extracted(frame, "page_id").collect()), key=repr)
    assert found == sorted([(1, LINES, len(LINES))] * 2 + [(None, LINES, len(LINES)), (2, "", 0)], key=repr)
