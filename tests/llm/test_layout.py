import time

import pytest

from lorewell.llm import layout
from lorewell.llm.layout import page_text

GOLDEN = [
    ("", ""), (None, None), ("  \n ", ""), ("plain &lt;b&gt; &amp; text", "plain <b> & text"),
    ("<html><head><title>T</title><body>a<!-- x -->b", "ab"),
    ("<p>one<p>two <b>bold</b>\n text", "one\n\ntwo bold text"),
    ("a<div>b</div>c", "a\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>z", "- a\n- b\n  3. x\n  4. y\n- c\n\nz"),
    ("<ol><li value=7>a<li>b</ol>", "7. a\n8. b"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<pre>  a\n   b</pre>x", "  a\n   b\n\nx"),
    ("<table><caption>Cap</caption><tr><th>Name<th>Value<tr><td>long name<td>1</table>", "Cap\nName      | Value\nlong name | 1"),
    ("<table><td>a<td>b<tr><td rowspan=2>r<td>2<tr><td>3</table>", "a | b\nr | 2\n  | 3"),
    ("<table><tr><td colspan=2>wide<td>x<tr><td>1<td>2<td>3</table>", "wide |   | x\n1    | 2 | 3"),
    ("<table><tr><td>o<table><tr><td>in</table>after</table>", "o\n\nin\n\nafter"),
    ("<div hidden>no</div><p style='color:red; display : none'>no</p>yes<input type=hidden value=n>", "yes"),
    ("<script>if (a < b) x('</p>')</script><style>p{}</style><template>t</template>ok", "ok"),
    ("<details><summary>S</summary>no<details open>no</details></details><details open><summary>A</summary>yes</details>", "S\nA\nyes"),
    ("<textarea>a <b> c</textarea>", "a <b> c"),
    ("x <!-- never closed <p>y", "x"), ("x<script>never closed", "x"), ("x<a href='never closed>y", "x"),
    ("a < b, 1 <2, </>x<?pi?><!doctype html>", "a < b, 1 <2, x"),
    ('<a title="x > y">link</a>', "link"), ("<p>it's<p data-x=\"it's\">fine", "it's\n\nfine"),
    ("<p>a</div></span>b</p>", "ab"), ("<b><i>x</b>y</i>", "xy"), ("</p>x", "x"),
    ("<select><option>one<option>two</select>", "one\ntwo"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
]


@pytest.mark.parametrize("page,text", GOLDEN)
def test_golden(page, text):
    assert page_text(page) == text


HOSTILE = [
    ("<!--", ""), ("<script>", ""), ("<a href='", ""), ("<div>", ""), ("<p>", ""), ("<table><td>", ""), ("<ul><li>", "</ol>"),
    ("<b>", "</i>"), ("<div>", "</p>"), ("<table><tr><td colspan=1000 rowspan=65534>", ""), ("<details><summary>", "x"), ("<td>", ""),
]


@pytest.mark.parametrize("prefix", ["", "<p><table><td>", "<table>", "<dl>"])
@pytest.mark.parametrize("opener,closer", HOSTILE)
def test_time_grows_with_the_page(prefix, opener, closer):
    def took(n):
        start = time.perf_counter()
        page_text(prefix + opener * n + closer * n)
        return time.perf_counter() - start

    took(1000)
    small, large = took(4000), took(16000)
    assert large < 12 * small + 0.5


def test_no_text_is_lost_or_made_up():
    """The words of generated trees come out once each, in order."""
    import random

    draw = random.Random(6)
    for _ in range(200):
        out, words, open_ = [], [], []
        for i in range(draw.randint(1, 60)):
            kind = draw.random()
            if kind < 0.5:
                words.append(f"w{i}")
                out.append(f" w{i} ")
            elif kind < 0.8 or not open_:
                open_.append(draw.choice(["div", "p", "ul", "b", "section", "blockquote", "span", "h2"]))
                out.append(f"<{open_[-1]}>")
            else:
                out.append(f"</{open_.pop()}>")
        text = page_text("".join(out))
        assert text.split() == words


def test_frame(spark):
    rows = [(1, "<p>a", "t"), (2, None, None), (3, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = layout.extract_text(pages)
    assert got.columns == ["page_id", "html", "text", "text_"]
    assert [r["text_"] for r in got.collect()] == ["a", None, ""]
    assert layout.extract_text(pages.limit(0)).count() == 0
