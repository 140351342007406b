import random
import time

import plain_html
import pytest

from ledgerline.llm import html_text as H

CASES = [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("a<b>b</b> c <i> d</i>e", "ab c de"),
    ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    ("x<br>y<br><br>z", "x\ny\nz"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
    ("<table><tr><th>Name<th>N<tr><td>a<td>100<tr><td colspan=2>wide<tr><td>bbb<td>1</table>", "Name | N\na    | 100\nwide\nbbb  | 1"),
    ("<table><tr><td>a<td><table><tr><td>i<td>j</table><tr><td>bb<td>c</table>", "a  | i | j\nbb | c"),
    ("<div style='DISPLAY : none'>no</div><p hidden>no</p><span aria-hidden=true>no</span>yes", "yes"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b></div>", "yes"),
    ("<script>var t='</p>';</script><style>p{}</style><title>t</title>body", "body"),
    ("<html><head><title>t</title><p>in body", "in body"),
    ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    ("&lt;b&gt; &amp; &#233;&nbsp;x", "<b> & é x"),
    ("</p></div>stray<!-- c --><unknown>x</unknown>", "strayx"),
    ("<p>a</table>b<td>c", "abc"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"),
    # declarations and tags that never end
    ("<![foo <p>b</p>", "b"), ("a<![CDATA[x]]>b", "ab"), ("a<!ELEMENT x>b<?php 1 ?>c", "abc"), ("a<!-- b", "a"), ("a<b class=", "a"), ("1 < 2 & 3 <", "1 < 2 & 3 <"),
    ("a<!-->b<!--->c<!-- x --!>d", "abcd"),
    # content of tables outside of cells
    ("<table><tr><form><td>alpha</td><td>beta</td></form></tr></table>", "alpha | beta"),
    ("<table><tr>stray<td>a</td></tr></table>", "stray\n\na"), ("<table><b>x</b><td>a<tbody>y<tr><th>b</table>z", "xy\n\na\nb\n\nz"),
    ("<table><tbody hidden><tr><td>no</tbody><tbody><tr><td>yes</table>", "yes"),
    ("<table><tr style='display:none'><td>no<tr><td>yes</table>", "yes"),
    ("<table><tr><td>a<table><tr><td>b</table>c</table>", "a b c"), ("<table><tr><table><tr><td>b</table>", "b"),
    ("<table><caption>cap</caption><tfoot><tr><td>foot</tfoot><tbody><tr><td>x</tbody><thead><tr><td>head</thead></table>", "cap\nhead\nx\nfoot"),
    # cells of several rows and columns
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A | B\n  | C"),
    ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>dd<td>e<tr><td>f</table>", "a  | b | c\ndd |   | e\nf  |"),
    ("<table><tr><td colspan=2>wider than both<td>x<tr><td>a<td>b<td>y</table>", "wider than both | x\na | b           | y"),
    ("<table><tr><td rowspan=3>a<td>b</table>c", "a | b\n\nc"), ("<table><tr><td colspan=1000>w<td>x<tr><td>a<td>b</table>", "w     | x\na | b"),
    # foreign elements
    ("<body><svg/>rest<p>more", "rest\n\nmore"), ("<svg><path d=''/><title>t</title><text>drawn</text>no</svg>after", "drawnafter"),
    ("a<svg><g><p>out</p>", "a\n\nout"), ("x <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>no</annotation></math> y", "x a+b y"),
    ("<math/>z", "z"), ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"),
    # forms
    ("<select><option>a<option selected>b<option>c</select>", "b"), ("<select><option disabled>a<optgroup><option>b</select>!", "b!"),
    ("<select multiple><option>a<option label=bee>b</select>", "a\nbee"), ("<datalist><option>no</datalist>", ""),
    ("<textarea>a <b>\n &amp; c</textarea>", "a <b>\n & c"), ("<input type=submit value=Go><input value=no><input type=hidden value=no>", "Go"),
    ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"), ("a</br>b", "a\nb"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_rendering(html, text):
    assert H.visible_text(html) == text


def test_implied_ends_build_siblings():
    root = H.parse("<ul><li>a<li>b</ul><p>x<p>y<table><tr><td>1<td>2<tr><td>3</table>")
    shape = lambda n: n if isinstance(n, str) else [n.tag, *map(shape, n.children)]
    assert shape(root) == ["#root", ["ul", ["li", "a"], ["li", "b"]], ["p", "x"], ["p", "y"],
                           ["table", ["tr", ["td", "1"], ["td", "2"]], ["tr", ["td", "3"]]]]


@pytest.mark.parametrize("html", ["<div>" * 30000 + "x" + "</div>" * 30000, "<p>" + "word " * 200000, "<li>" * 20000 + "x",
                                  "<!--" * 100000, "<a " * 100000, "</a " * 100000, "<![" * 100000, "<table><tr><td>" * 2000 + "deep",
                                  "<b><table><tr><td>" + "<div>" * 20000 + "</b>" * 20000 + "x", "&" * 300000, "<" * 300000, "<svg>" * 20000 + "x",
                                  "<table>" + "<tr><td colspan=1000 rowspan=5>x" * 3000, "<select>" + "<option>" * 50000, "<p hidden>" * 20000, "\0" * 100000])
def test_hostile_pages_do_not_recurse_or_crawl(html):
    start = time.time()
    H.visible_text(html)
    assert time.time() - start < 20


def test_long_pages_are_whole():
    assert H.visible_text("<div>" * 30000 + "x" + "</div>" * 30000) == "x"
    assert H.visible_text("<table><tr><td>" * 60 + "deep") == "deep"
    assert H.visible_text("<p>" + "word " * 200000).count("word") == 200000


def test_layout_equals_a_plain_renderer():
    rng = random.Random(9)
    tags = ["p", "div", "b", "ul", "ol start=4", "li", "li value=7", "table", "tr", "td", "td rowspan=2", "td colspan=3", "th", "thead", "tbody", "tfoot hidden",
            "caption", "form", "pre", "dl", "dt", "dd", "h2", "span hidden", "div style='visibility:hidden'", "i style='visibility:visible'", "details", "summary", "blockquote"]
    for _ in range(3000):
        parts = []
        for _ in range(rng.randrange(1, 30)):
            kind = rng.random()
            tag = rng.choice(tags)
            parts.append(f"<{tag}>" if kind < 0.5 else f"</{tag.split()[0]}>" if kind < 0.7 else rng.choice([" a", "bb ", "c", "d  e", "\n", "<br>"]))
        html = "".join(parts)
        assert H.visible_text(html) == plain_html.visible_text(html), html


def test_pages_equal_a_plain_renderer(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in pages:
        assert H.visible_text(r.html) == plain_html.visible_text(r.html)


def test_every_visible_word_of_the_pages_is_kept(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r.page_id: r for r in H.extract_pages(pages.withColumn("text", pages.url)).collect()}
    import re
    for r in pages.collect():
        body = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->", " ", r.html)
        import html
        want = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        got = [w for line in out[r.page_id].text.split("\n") for w in re.sub(r"^\s*- ", "", line).split()]
        assert got == want
    assert all(r.n_lines == (r.text.count("\n") + 1 if r.text else 0) for r in out.values())


def test_null_rows(spark):
    pages = spark.createDataFrame([(None, None, "x"), (1, "", "y"), (1, "<p>a", "z")], "page_id long, html string, text string")
    assert sorted((r.text, r.n_lines) for r in H.extract_pages(pages).collect()) == [("", 0), ("", 0), ("a", 1)]
