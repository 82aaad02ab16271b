import time

import pytest

from tiermill.llm.html_text import render, visible_text
from tiermill.llm.queries import op7_html

SF_DIR = "/root/testdata/sf0.001"

CASES = [
    (None, ""),
    ("", ""),
    ("  \n ", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b", "a\n\nb"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("<b>a</b><i>b</i> c", "ab c"),
    ("<h1>T</h1>x<h2>U</h2>", "T\n\nx\n\nU"),
    ("<ul><li>a<li>b</ul>c", "- a\n- b\n\nc"),
    ("<ol start=9><li>a<li>b<p>c</ol>", "9. a\n10. b\n\n    c"),
    ("<ul><li>a<ul><li>b</ul></ul>", "- a\n\n  - b"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td colspan=2>a<td>b<tr><td>c<td>d<td>e</table>", "a     b\nc  d  e"),
    ("<table><caption>t</caption>loose<tr><div>x</div><td>a</table>", "loose\nx\nt\na"),
    ("<head><title>t</title></head><body>x", "x"),
    ("<script>if (a<b) '<p>'</script>a<style>b</style>", "a"),
    ("<script>never ends <p>x", ""),
    ("<textarea>a<b></textarea>", "a<b>"),
    ("<div hidden>a</div><p style='color:red; DISPLAY : none'>b</p>c", "c"),
    ("<p style='visibility:hidden'>a</p>b<noscript>c</noscript>", "b"),
    ("<!-- a -- > b -->c<!doctype html>d", "cd"),
    ("a < b <3 </ 1> &lt;p&gt;", "a < b <3 </ 1> <p>"),
    ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    ("<img alt='pic'> x", "pic x"),
    ("<p>a</div>b</p>c", "ab\n\nc"),
    ("<A HREF='x>y'>a</A>", "a"),
    ("a<", "a<"),
    ("<p", ""),
    ("a&nbsp;b", "a b"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_render(page, text):
    assert render(page) == text


@pytest.mark.parametrize("tag", ["div", "ul><li", "table><tr><td", "ol><li", "b", "p"])
def test_deep_pages(tag):
    assert render(f"<{tag}>x" * 1500).count("x") == 1500


def test_long_page():
    assert render("<p>word</p>\n" * 30_000).count("word") == 30_000
    assert render("a " * 200_000).count("a") == 200_000


def test_rows(spark):
    pages = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, None, "")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    found = visible_text(df)
    assert found.columns == ["page_id", "url", "text"]
    want = [(1, "u", "a"), (1, "u", "a"), (None, None, ""), (2, None, "")]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert visible_text(df.limit(0)).count() == 0


def test_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = op7_html(spark, SF_DIR).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: render(h) for i, h in pages.items()}
    assert len(found) == len(pages)
    assert not any("track(" in r["text"] or "margin:0" in r["text"] for r in found)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>T</title><p>text", "text"),
        ("<head><title>T</title>\n<meta charset=x><link href=y> text <b>b</b>", "text b"),
        ("<head><style>s</style><script>x</script><noscript><p>n</p></noscript><h1>a</h1>b", "a\n\nb"),
        ("<head><template><p>t</p></template><base href=x><div>a</div>", "a"),
        ("<head>\n<title>T</title>\n</head>\n<body>a", "a"),
    ],
)
def test_a_head_ends_without_a_tag(page, text):
    assert render(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<a href="x"">a</a> <p>b</p>', "a\n\nb"),
        ("<a href=/o'brien>a</a> b <i title='c'>d</i>", "a b d"),
        ("<a title=say\"so>a</a><p hidden>b</p>c", "ac"),
        ('<a "x>a</a><b title = "p>q">b</b>', "ab"),
        ("<img alt='x>y'hidden><img alt=it's src=\"a'b\"> z", "it's z"),
        ("<a href=>a</a><a =\"b>c</a>", "ac"),
        ("a<b title='never ends>x", "a"),
    ],
)
def test_quotes_open_strings_only_where_a_value_begins(page, text):
    assert render(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
        ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  b  c\nd     e\nf     g"),
        ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a  b\nc  d"),
        ("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c</table>", "a    b\n     c"),
        ("<table><tr><td colspan=200>a<td>b</table>", "a" + "  " * 200 + "b"),
        ("x <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>tex</annotation></math> y", "x a+b y"),
    ],
)
def test_spans_and_formulas(page, text):
    assert render(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 200_000, "</div>" * 200_000, "<p><button>" + "<div>" * 100_000,
        "<div>" * 100_000 + "</p>" * 100_000, "<td>" * 100_000, "<b>" * 100_000 + "</i>" * 100_000,
        "<li>" * 100_000, "word " * 400_000, "<pre>" + "a\n" * 200_000,
    ],
)
def test_broken_pages_take_time_in_proportion(page):
    started = time.process_time()
    assert render(page + "end").endswith("end")
    assert time.process_time() - started < 20
