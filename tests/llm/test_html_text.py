import re
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regflow.llm.html_text import extract_text, text_of

CASES = [
    (None, ""), ("", ""), ("plain", "plain"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("<h1>T</h1>x", "T\n\nx"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>d", "- a\n- b\n  - c\n\nd"),
    ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
    ("<table><tr><td>a<td>long one<tr><td>bbb<td>c</table>", "a    long one\nbbb  c"),
    ("<table><td>x<tfoot><tr><td>f</tfoot><thead><tr><th>h</thead></table>", "h\nx\nf"),
    ("<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>", "wide cell\na  b"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table>loose<tr><td>x</table>", "loose\n\nx"),
    ("<p hidden>no</p><p style='color:red; display : none'>no</p><i style='visibility:hidden'>no<b style='visibility:visible'>yes</b></i>", "yes"),
    ("<script>x='<p>'</script><style>p{}</style><noscript>n</noscript><template>t</template>ok<!-- c --><!doctype html>", "ok"),
    ("<pre>\n a\n   b</pre>", " a\n   b"),
    ("&amp;&lt;b&gt; &eacute;&#233;&#x41;&nbsp;x &bogus;", "&<b> ééA\xa0x &bogus;"),
    ("a &lt b < c <3 d</ e>f", "a < b < c <3 df"),
    ("<a href='x>y' title=\"</a>\">link</a> t", "link t"),
    ("  a \n\t b  <b> c </b> d ", "a b c d"),
    ("<title>no</title><body>x</p>y", "x\n\ny"),
    ("<p>unclosed <b>bold<p>next", "unclosed bold\n\nnext"),
    ("<script>never closed <p>a", ""), ("x<!-- never closed", "x"), ("x<p", "x"),
    ("<dl><dt>t<dd>d1<dd>d2<dt>u</dl>", "t\n  d1\n  d2\nu"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_cases(html, text):
    assert text_of(html) == text


class Plain(HTMLParser):
    """Words of a well-formed page, without layout."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")
        self.words.append(" ")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")
        self.words.append(" ")

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)


def test_pages_keep_every_visible_word(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.id: r.text for r in extract_text(pages).collect()}
    assert len(got) == pages.count()
    for page in pages.collect():
        plain = Plain()
        plain.feed(page.html)
        plain.close()
        words = [w for w in re.split(r"\s+", "".join(plain.words)) if w]
        mine = [w for w in re.split(r"\s+", got[page.page_id]) if w and w != "-"]
        assert mine == [w for w in words if w != "-"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<table>", "</table>", "<tr>", "<td>", "</td>", "<ul>", "<li>", "</ul>", "<div>", "</div>", "<pre>", "</pre>", "w ", "x", "<br>", "<h1>", "</h2>", "<a>", "<option>", "</tr>", "<caption>", "<dd>"]), max_size=30))
def test_no_text_is_lost(parts):
    html = "".join(parts)
    letters = re.sub(r"<[^>]*>|\s", "", html)
    assert sorted(re.sub(r"[\s-]", "", text_of(html))) == sorted(letters)


LEFT_OUT = [
    ("<table><colgroup><col><tr><td>text</table>", "text"),
    ("<table><colgroup><col><thead><tr><th>h<tbody><tr><td>b</table>", "h\nb"),
    ("<table><colgroup><col><td>a<td>b</table>c", "a  b\n\nc"),
    ("<table><colgroup>loose<tr><td>x</table>", "loose\n\nx"),
    ("<table><colgroup><col><caption>cap</caption><tr><td>x</table>", "cap\nx"),
    ("<head><title>t</title>Hello <b>you</b>", "Hello you"),
    ("<head><title>t</title> <meta a=b>\n&amp; more<p>next", "& more\n\nnext"),
    ("<html><head><style>p{}</style><script>s</script>x</html>", "x"),
    ("<div>a<head>b</div>c", "ab\nc"),
    ("<table><p><table>w", "w"),
]


@pytest.mark.parametrize(("html", "text"), LEFT_OUT)
def test_tags_left_out(html, text):
    assert text_of(html) == text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["<head>", "</head>", "<body>", "<colgroup>", "</colgroup>", "<col>", "<table>", "</table>", "<thead>", "<tbody>", "<tr>", "<td>", "</td>", "<caption>", "<p>", "</p>", "</br>", "<b>", "<div>", "</div>", "<meta>", "w ", "x", " "]), max_size=30))
def test_no_text_is_lost_in_columns_and_heads(parts):
    html = "".join(parts)
    letters = re.sub(r"<[^>]*>|\s", "", html)
    assert sorted(re.sub(r"[\s-]", "", text_of(html))) == sorted(letters)


@pytest.mark.parametrize("html", ["<div>" * 50_000 + "x", "<b>" * 50_000 + "x" + "</i>" * 50_000, "<table><tr><td>" * 3_000 + "x", "<p>y" * 50_000 + "x", "<ul><li>" * 20_000 + "x", "<a b='" * 20_000 + "<i>x", "<" * 100_000 + " x", "w " * 500_000 + "x"])
def test_long_and_deep(html):
    assert "x" in text_of(html) or "'" in html


def test_rows(spark):
    rows = [(1, "<p>a", "t", 5), (1, "<p>a", "t", 5), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, id int")
    assert sorted(map(tuple, extract_text(pages).collect()), key=str) == [(1, "a"), (1, "a"), (None, "")]
    assert extract_text(pages.limit(0)).count() == 0


SHOWN = [
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> b", "a x=2 b"),
    ("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr><mtr><mtd>3</mtd></mtr></mtable></math>", "1 2\n3"),
    ("a<svg><title>no</title><defs><text>no</text></defs><path d='M0'/><g><text x=1>one <tspan>two</tspan></text></g>no<text>three</text></svg>b", "a\none two\nthree\nb"),
    ("<svg><defs/><title/><text>yes</text><text visibility='hidden'>no</text></svg>", "yes"),
    ("<a><svg><path/></svg> link</a>", "link"),
    ("a<xmp><b>x</b> &amp;\n  y</xmp>b", "a\n\n<b>x</b> &amp;\n  y\n\nb"),
    ("<table><tr><xmp>loose</xmp><svg><text>t</text></svg><td>x</table>", "loose\n\nt\n\nx"),
]


@pytest.mark.parametrize(("html", "text"), SHOWN)
def test_formulas_drawings_and_xmp(html, text):
    assert text_of(html) == text


DEEP = [
    ("a<i hidden>no<b>no</b></i>b", "ab"),
    ("a<script>no</script><template>no<template>no</template></template><p style='display:none'>no<p>b", "ab"),
    ("<i style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</i>b", "yesb"),
    ("<dialog>no<p hidden>no</p></dialog><dialog open>yes</dialog>", "yes"),
    ("a<svg><title>no</title><defs><text>no</text></defs><text>t</text>no</svg>b", "atb"),
    ("a<noscript>no<noscript>no</noscript>no</noscript><table hidden><tr><td>no</table>b", "ab"),
]


@pytest.mark.parametrize(("html", "text"), DEEP)
@pytest.mark.parametrize("depth", [150, 199, 200, 201, 260, 3000])
def test_hidden_is_hidden_at_any_depth(html, text, depth):
    for wrap in ("<b>", "<div>", "<section><i>"):
        got = text_of(wrap * depth + html + "z")
        assert re.sub(r"\s", "", got) == text + "z", (wrap, got)


@pytest.mark.parametrize("part", ["<i style='visibility:visible'>", "<i hidden>", "<svg>", "<svg><text>", "<template>", "<p style='visibility:inherit'>"])
def test_many_deep_elements_that_decide(part):
    assert "a" in text_of("a" + part * 30_000 + "x")
