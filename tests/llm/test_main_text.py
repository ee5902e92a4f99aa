"""Page extraction on hand-written pages and on the generated ones."""

from __future__ import annotations

import html
import re
import time

import pytest

from curbsight.llm.main_text import extract, main_text

LONG = "This sentence, which has commas, belongs to the article and is long enough to score."


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<p>One.</p>", "One."), ("plain  text\n here", "plain text here"),
    (f"<body><nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>{LONG}<p>B&nbsp;c&#33;</article>"
     "<footer>foot</footer>", f"T & U\n{LONG}\nB c!"),
    (f"<div id=sidebar><p>{LONG}</p></div><div class='content'><p>{LONG}</p><ul><li>a<li>b</ul></div>",
     f"{LONG}\na\nb"),
    (f"<main><p>{LONG}</p><form><p>{LONG}</p></form><div class='cookie-notice'>{LONG}</div><p>x</p></main>",
     f"{LONG}\nx"),
    (f"<article><p>{LONG}</p><section class=comments><p>{LONG}</p><p>{LONG}</p></section></article>", LONG),
    (f"<article><p>{LONG}</p></article><div id='comments'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", LONG),
    (f"<article><section><p>{LONG}</p></section><section><h2>S</h2><p>{LONG}</p></section></article>",
     f"{LONG}\nS\n{LONG}"),
    (f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{LONG}</p></article>",
     f"Title\n{LONG}"),
    (f"<article><p>a<script>var t='</p>';</script>b<style>p{{}}</style></p><!-- <p>no</p> --><p>{LONG}</p></article>",
     f"ab\n{LONG}"),
    (f"<article><p><b>bold<br><p>{LONG}<br>more</p></article>", f"bold\n{LONG} more"),
    (f"<table><tr><td>1<td>2<tr><td>{LONG}</table>", f"1\n2\n{LONG}"),
    (f"<article><pre>a\n  b</pre><blockquote>{LONG}</blockquote><aside>{LONG}</aside></article>", f"a b\n{LONG}"),
    (f"<article><p>{LONG}</p><p>5 < 6 && 7 &lt; 8 &amp</p></article>", f"{LONG}\n5 < 6 && 7 < 8 &"),
    (f"<article><p>{LONG}</p><p class=", LONG), (f"<article><p>{LONG}</p><!-- open", LONG),
    (f"<ARTICLE><P>{LONG}</P><DIV CLASS=\"Ad\">buy</DIV></ARTICLE>", LONG),
    (f"<article><p>{LONG}</p><div hidden>x</div><div style='display: none'>y</div></article>", LONG),
    (f"<article><p>{LONG}</p></i></b></div><p>z</p></article>", f"{LONG}\nz"),
    (f"<div><a href=a>{LONG}</a> <a href=b>{LONG}</a></div><div><p>{LONG}</p><p>{LONG}</p></div>",
     f"{LONG}\n{LONG}"),
])
def test_pages(source, text):
    assert main_text(source) == text


@pytest.mark.parametrize("n", [1, 9, 40])
@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_what_stands_beside_the_body_is_kept_on_pages_of_any_size(n, around):
    body = f"<p>{LONG} {LONG} {LONG} {LONG}</p>" * n
    found = main_text(f"<nav><a href=x>Home</a></nav><{around}><h1>T</h1><p>Short intro.</p><div class=body>{body}</div>"
                      "<ul><li>a<li>b</ul><table><tr><td>1<td>2</table><dl><dt>c<dd>d</dl><figure><figcaption>e"
                      f"</figcaption></figure><ul><li><a href=y>More</a></ul><aside>f</aside></{around}>")
    want = "\n".join(["T", "Short intro.", *[" ".join([LONG] * 4)] * n, *"ab12cde"])
    # The links belong to an article; beside a container they are a menu.
    assert found == f"{want}\nMore" or around == "div" and found == want


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + f"<p>{LONG}</p>") == LONG
    many = "<article>" + f"<p>{LONG}</p>" * 5_000 + "</article>"
    assert main_text(many) == "\n".join([LONG] * 5_000)


def test_generated_pages_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in extract(pages).collect():
        article = re.search(r"<article>(.*)</article>", sources[row["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?(b|br)>", " ", x)).split())
                  for x in re.split("</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b)


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>a</p>", "x"), (2, "u", "", "x"), (2, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"], r["url"], r["text"]) for r in extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", ""), (None, None, "a"), (2, "u", ""), (2, "u", "")], key=repr)
    assert extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("name", [
    "content no-sidebar", "post-with-comments", "content-with-sidebar", "entry-content no-comments", "post has-banner",
    "share-of-market", "sidebar-left layout"])
def test_a_name_that_only_mentions_an_aside_costs_nothing(name):
    body = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
    for attribute in ("class", "id"):
        assert main_text(f'<body><div {attribute}="{name}">{body}</div><footer>foot</footer></body>') == f"T\n{LONG}\n{LONG}"


def test_paragraphs_of_an_article_stay_whatever_their_name():
    found = main_text(f"<article><p>{LONG}</p><p class='alert'>a</p><p id=notice>b</p><div class='related-work'><p>c</p></div>"
                      "<h2 class=banner>d</h2><div class='related-posts'>e</div><div class='ad ad-slot-2'>f</div></article>")
    assert found == f"{LONG}\na\nb\nc\nd"


def test_asides_by_name_go():
    for name in ("ad", "site-footer", "cookie-consent-manager", "comments", "comment-list", "left-sidebar", "main-nav", "Related-Posts x"):
        assert main_text(f"<div class=body><p>{LONG}</p><p>{LONG}</p></div><div class='{name}'><p>{LONG} {LONG} {LONG}</p></div>") \
            == f"{LONG}\n{LONG}", name


def test_names_do_not_count_where_nothing_would_be_left():
    assert main_text(f"<div class=banner><article><p>{LONG}</p></article></div><p>x</p>") == LONG
    assert main_text(f"<div class=widget><p>{LONG}</p></div>") == LONG
    # An article among related ones is no reason to keep those.
    assert main_text(f"<article><p>{LONG}</p></article><div class=related><article><p>a</p></article></div>") == LONG


def test_several_articles():
    assert main_text(f"<div><article><p>{LONG}</p></article></div><section><article><p>b</p></article></section>") == f"{LONG}\nb"
    assert main_text(f"<div><article><p>{LONG}</p></article></div><section><article><a href=x>b</a></article></section>") == LONG


def test_quotes_in_tags():
    for tag in ("p class=it's", 'p class=5"', "p title='a>b'", 'p title="a>b" x=\'y\'', "p it's", "p a = 'b' c=d'e", "p a="):
        assert main_text(f"<article><{tag}>{LONG}</p><p>z</p></article>") == f"{LONG}\nz", tag


@pytest.mark.parametrize("piece", ["<b>", "<p>", "<div>", "<b>x", "<li>", "<td>", "</i>", "<b></p>", "<p><b>", "<", "<a x='", "<tr><td>",
                                   "<script>", "<!-- ", "<span class=ad>", "<b>a<p>b", "<ul><li>", "</div>"])
def test_a_megabyte_of_tags_takes_no_time(piece):
    begin = time.process_time()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.process_time() - begin < 15
    # The time follows the length: four times the page must not take sixteen times as long.
    spent = []
    for n in (100_000, 400_000):
        begin = time.process_time()
        main_text(piece * (n // len(piece)))
        spent.append(time.process_time() - begin)
    assert spent[1] < 10 * spent[0] + 0.5
