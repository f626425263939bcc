"""Main text of pages."""

import html as entities
import re

import pytest
from conftest import CHECK

from aeropanel.llm import html_text

LONG = "This sentence belongs to the article and says quite a lot about its subject, more than once. "


def test_article_of_every_given_page(spark):
    pages = spark.read.parquet(f"{CHECK}/pages.parquet").withColumnRenamed("url", "text")
    got = html_text.with_main_text(pages, "main").collect()
    assert len(got) == 250
    for row in got:
        article = row.html[row.html.index("<article>"):row.html.index("</article>")]
        parts = re.split(r"</?(?:p|h1|article)>", article.replace("<br>", " "))
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
        assert row.main == "\n\n".join(b for b in blocks if b)


PAGE = f"""<!DOCTYPE html><html><head><title>Head</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies. {LONG * 3}</div>
<div id="content"><h1>Title &amp; more</h1><div class="entry"><p>{LONG}&nbsp; second   line<br>third<p>{LONG}<b>bold</b> <a href=x>link</a>.
<ul><li>one<li>two &lt;b&gt;</ul><table><tr><td>cell<td>next</table><script>var x = "<p>no</p>"</script>
<form><p>Subscribe now {LONG}</p></form><div class="ad-banner">Buy {LONG}</div></div></div>
<aside><p>{LONG * 4}</p></aside><section id="comments"><article class="comment"><p>{LONG * 9}</p></article></section>
<footer><p>About us {LONG}</p></footer>"""


def test_a_page_without_an_article_element():
    first, second = f"{LONG}second line third", f"{LONG}bold link."
    assert html_text.main_text(PAGE) == "\n\n".join(["Title & more", first, second, "one", "two <b>", "cell", "next"])


def test_header_of_an_article_keeps_its_headings():
    page = f"<body><article><header><h1>Head</h1><p>by nobody</p></header><p>{LONG}</p></article><article class=comment>{LONG * 5}</article>"
    assert html_text.main_text(page) == f"Head\n\n{LONG.strip()}"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("only text", "only text"), ("<p>a<p>b", "a\n\nb"), ("<script>x</script>", ""), ("<", "<"),
    ("<p>a <b>c<p>d</b> e", "a c\n\nd e"), ("</p></div>x", "x"), ("<p>" * 3000 + "deep", "deep"), ("<div>" * 3000 + "deep", "deep"),
    ("<body><p>&#233;&eacute;&unknown;</p></body>", "éé&unknown;"), ("<nav>menu</nav>", "")])
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("before, after", [
    ("<form id=aspnetForm><input name=s><label>Search here</label><article>", "</article></form>"),
    ("<form><div><p>", "</div></form>"), ("<article class='post comments-open'>", "</article>"), ("<div class=has-comments><article>", "</article></div>"),
    ("<div class=comments><article>", "</article></div>"), ("<div role=dialog><article>", "</article></div>"),
    *((f"<div class={name}><div><p>", "</div></div>") for name in ("with-sidebar", "no-sidebar", "share-page", "widget-text")),
    ("<article><div class=widget-text>", "</div></article>")])
def test_wrappers_of_the_article_are_kept(before, after):
    page = f"<body><nav><a href=/>Home</a></nav>{before}{LONG * 3}{after}<div class=sidebar>{LONG}</div><div id=comments>{LONG}</div></body>"
    assert html_text.main_text(page) == (LONG * 3).strip()


def test_formulas_are_text():
    page = f"<article><p>{LONG}<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math></article>"
    assert html_text.main_text(page) == f"{LONG}x=1"


def test_comments_that_are_articles_are_left_out():
    page = f"<article>{LONG}</article><div id=comments><article>{LONG * 9}</article></div>"
    assert html_text.main_text(page) == LONG.strip()


def test_very_long_page():
    page = "<article>" + "".join(f"<p>{LONG}{i}</p>" for i in range(20_000)) + "</article>"
    assert html_text.main_text(page).count("\n\n") == 19_999


def test_no_pages(spark):
    assert html_text.with_main_text(spark.createDataFrame([], "page_id long, html string")).count() == 0
