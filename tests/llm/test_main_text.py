"""Articles of pages in many shapes."""

import html
import re
import time

import pytest

from rolehabit.llm.common import QUERIES
from rolehabit.llm.main_text import extract, main_text

P = "This paragraph is long enough, with commas, to be taken for the running text of a page."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("just words", "just words"), ("<p>a &lt;b&gt;&nbsp;c", "a <b> c"), ("1 < 2", "1 < 2"),
        (f"<body><nav><a href=x>Home</a></nav><div><p>{P}<p>{P}</div><footer>f</footer>", f"{P} {P}"),
        (f"<div id=main><h1>T</h1><p>{P}</p></div><div class='side-bar sidebar'><p>{P}</p></div>", f"T {P}"),
        (f"<article><header><h1>Title</h1></header><p>{P}</p><section class=comments><p>{P}</p></section></article>", f"Title {P}"),
        (f"<header><p>{P}</p></header><main><p>{P}</p><form><p>{P}</p></form></main>", P),
        (f"<script>var a='<p>{P}</p>'</script><style>p{{}}</style><!-- <p>{P}</p> --><p>{P}</p>", P),
        (f"<div><p>a<b>b</b>c<br>d\n e</p><ul><li>{P}<li>{P}</ul></div>", f"abc d e {P} {P}"),
        (f"<div class=links><a href=1>{P}</a> <a href=2>{P}</a></div><div><p>{P} {P}</p></div>", f"{P} {P}"),
        (f'<p title="a > b">{P}</p><p hidden>no</p><p', P),
        (f"<article><div>{P}</div><div>short</div></article>", f"{P} short"),
    ],
)
def test_page(page, text):
    assert main_text(page) == text


def test_long_and_deep():
    assert main_text("<div>" * 5000 + P + "</div>" * 5000) == P
    assert main_text(f"<article>{f'<p>{P}</p>' * 5000}</article>") == " ".join([P] * 5000)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div " * 100_000, None), ("<a" * 100_000, None), ('<a ">"' * 30_000, None), ("<a b='x\"<" * 50_000, None), ('<a b="<a b=" ' * 30_000 + "<", None),
        (f"{'<div>' * 100_000}{P}", P), (f"{'<div>' * 50_000}{P}{'</p></x>' * 50_000}", P), (f"<p><table><td>{'<div>' * 50_000}{P}", P),
        ("<ul><p>x</p>" * 30_000, None), ("<p>x<header>" * 30_000, None),
    ],
)
def test_time_is_linear(page, text):
    begin = time.process_time()
    got = main_text(page)
    assert time.process_time() - begin < 5
    assert text is None or got == text


def test_quotes_without_an_end():
    # the first bracket's quote never ends; later ones are whole
    assert main_text(f"<i '><p title=\"a > b\">{P}</p><p title=\">\">{P}</p>") == f"{P} {P}"


C = "".join(f"<div class=comment><p>{P} {P}</p></div>" for _ in range(8))


@pytest.mark.parametrize("name", ["class=comments", "id=reader-comments", "class='comment-list box'", "class=comments-area", "id='advert-2'", "class='cookie-notice'", "class=adBox"])
def test_remarks_longer_than_the_article(name):
    assert main_text(f"<article><p>{P}</p><section {name}>{C}</section></article>") == P
    assert main_text(f"<article><p>{P}</p></article><section {name}>{C}</section>") == P
    assert main_text(f"<body><div><p>{P}</p></div><div {name}>{C}</div></body>") == P
    assert main_text(f"<body><div {name}><article><p>{P}</p></article></div></body>") == P


def test_articles_that_are_comments():
    comments = f"<div id=comments>{f'<article class=comment-body><p>{P} {P}</p></article>' * 5}</div>"
    assert main_text(f"<main><article class='post comments-open'><p>{P}</p></article>{comments}</main>") == P
    assert main_text(f"<body><div><p>{P}</p></div>{comments}</body>") == P


def test_query(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op9_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        plain = re.sub(r"<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", article)
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (None, "u", f"<p>{P}</p>", 2), (3, "u", "", 3), (3, "u", "", 3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert sorted(map(tuple, extract(frame).collect()), key=repr) == sorted([(1, None, "", 0), (None, "u", P, len(P)), (3, "u", "", 0), (3, "u", "", 0)], key=repr)
    assert extract(frame.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["class='page with-sidebar'", "class=no-sidebar", "class='content has-comments'", "class=post-widget", "class=search-result", "id='notice-text'"])
def test_names_around_the_article(name):
    assert main_text(f"<body><div {name}><article><h1>T</h1><p>{P}</p></article></div></body>") == f"T {P}"
    assert main_text(f"<body><div {name}><p>{P}</p><p>{P}</p></div><div><p>{P}</p></div></body>").startswith(f"{P} {P}")
    assert main_text(f"<body><div><p>{P}</p><p>{P}</p></div><div class='widget sidebar'><p>{P}</p></div></body>") == f"{P} {P}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<h1>T</h1><p>{P}</p><p>{P}</p>", f"T {P} {P}"), (f"<p>A</p><p>{P}</p>", f"A {P}"), (f"<p>{P}</p><div><a href=x>{P}</a></div>", P),
        (f"<div><section><p>{P}</p><p>{P} {P}</p></section><section><p>short one</p></section></div>", f"{P} {P} {P} short one"),
        (f"<body><div><section>{f'<p>{P}</p>' * 9}</section><section><p>{P}</p></section></div></body>", " ".join([P] * 10)),
        (f"<article>loose before<div><p>{P}</p><p>{P}</p></div>and <b>after</b></article>", f"loose before {P} {P} and after"),
        (f"<body><div><h2>Head</h2>loose<section><p>{P}</p></section></div></body>", f"Head loose {P}"),
        (f"<body><div><a href=x>{P}</a><section><p>{P}</p></section></div></body>", P),
    ],
)
def test_no_part_is_lost(page, text):
    assert main_text(page) == text
