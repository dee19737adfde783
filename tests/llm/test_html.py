"""Visible text of pages: expected layouts, odd input, and a comparison with a plain reading of all text."""

import random
import re
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import html_text, queries
from tributary.llm.common import table

PAGES = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("a <b>b</b>  c\n d", "a b c d"),
    ("<div>a</div>b<div>c</div>", "a\nb\nc"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "* a\n* b\n  * c\n* d"),
    ("<ol><li>a</li><li>b</li></ol><ol start=5><li>e<li value=9>i<li>j</ol>", "1. a\n2. b\n\n5. e\n9. i\n10. j"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<table><tr><th>name<th>n<tr><td>a<td>10<tr><td>long one<td>2</table>", "name     | n\na        | 10\nlong one | 2"),
    ("<table><tr><td>a<br>b<td>c</table>", "a | c\nb |"),
    ("<table><tr><td colspan=2>wide<td>x<tr><td>1<td>2<td>3</table>", "wide  | x\n1 | 2 | 3"),
    ("<table><tr><td>中文<td>x<tr><td>a<td>y</table>", "中文 | x\na    | y"),
    ("<head><title>t</title><style>s{}</style></head><body>b<script>if (a < b) '</p>'</script>c", "bc"),
    ("<p hidden>x</p><p style='color:red; display : none'>y</p><div aria-hidden=true>z</div><p style='visibility:hidden'>w</p>v", "v"),
    ("a<!-- <p>no</p> -->b<!doctype html><?php x ?>c", "abc"),
    ("<pre>\n a  b\n  c</pre>d", " a  b\n  c\n\nd"),
    ("&amp;&lt;&copy;&nbsp;x &#65;", "&<©\xa0x A"),
    ("a < b and 3<4", "a < b and 3<4"),
    ("<img alt='a picture'> <img> x", "a picture x"),
    ("<p>a</div>b</p>c", "ab\n\nc"),
    ("</p>x</br>y", "x\ny"),
    ("<a title='a > b'>x</a>", "x"),
    ("<select><option>no</select><textarea> k </textarea>", " k"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("x<hr>y", "x\n\n---\n\ny"),
    ("<li>a<li>b", "* a\n* b"),
    ("<h1>t</h1>b", "t\n\nb"),
    ("<b>unclosed <i>tags</b> here", "unclosed tags here"),
    ("<table>stray<tr><td>x</table>", "stray\nx"),
    ("<template>t</template><noscript>n</noscript>y", "y"),
    ("<p>a<table><tr><td><p>b</p>c</table>d", "a\n\nb\n\nc\n\nd"),
    ("", ""), ("   \n", ""), ("<div></div>", ""), ("<", "<"), ("<p", ""), ("<!--", ""), ("<ul><li></li></ul>", "*"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_render(page, text):
    assert html_text.render(page) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <b> </b> <li> <ul> </ul> <table> <tr> <td> </table> <br> <pre> <script> </script> <!-- --> a b &amp; < > \" ' = / \n <div> </div>".split(" ")), max_size=40))
def test_any_text_renders(parts):
    text = html_text.render("".join(parts))
    assert text == text.rstrip("\n") and all(line == line.rstrip() for line in text.split("\n"))


SHOWN = [
    ("<p>so <math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></semantics></math> holds</p>", "so x=1 holds"),
    ("<svg><title>no</title><desc/><defs><text>no</text></defs><path d='M0'/><text x=1>a</text><text>b</text></svg>c", "a\nb\nc"),
    ("<svg><title/><style/><text>a</text></svg>b", "a\nb"),
    ("<svg><foreignObject><desc>a</desc></foreignObject></svg>b", "ab"),
    ("<object data=x><p>instead</p></object>", "instead"),
    ("<datalist><option>no</datalist>a", "a"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
    ("<table><tr><td>a<td rowspan=0 colspan=2>b<td>c<tr><td>d<td>e<tbody><tr><td>f<td>g</table>", "a | b    | c\nd |      | e\nf | g"),
]


@pytest.mark.parametrize("page,text", SHOWN)
def test_what_a_browser_shows(page, text):
    assert html_text.render(page) == text


VISIBILITY = [
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>v", "yes\nv"),
    ("<div style='visibility:hidden'>no<ul><li>no<li style='visibility:visible'>a</ul></div>", "* a"),
    ("<p style='visibility:visible;display:none'>no<b style='visibility:visible'>no</b></p>v", "v"),
    ("<table><tr><td style='visibility:hidden'>no<td>a<tr><td>b<td>c</table>", "  | a\nb | c"),
    ("<div style='visibility:collapse'><img alt=no><hr>no<input value=no></div>v", "v"),
    ("<input type=submit value='Go on'> <input value=typed><input type=password value=no><input type=checkbox value=no>", "Go on typed"),
    ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
    ("<ol reversed start=10><li>a<li value=4>b<li>c</ol>", "10. a\n4. b\n3. c"),
    ("<pre>x\n<table><tr><td>a<td>b</table></pre>", "x\n\na | b"),
    ("<pre>x  y<ul><li>a  a<li>b</ul></pre>z", "x  y\n\n* a  a\n* b\n\nz"),
]


@pytest.mark.parametrize("page,text", VISIBILITY)
def test_visibility_is_handed_down(page, text):
    assert html_text.render(page) == text


def _made(rng, depth=0, shown=True, displayed=True):
    """A random element and the words of it that are visible."""
    style, words, page = rng.choice(["", "", "visibility:hidden", "visibility:visible", "display:none", "color:red;visibility:collapse"]), [], ""
    displayed &= style != "display:none"
    if "visibility" in style:
        shown = style == "visibility:visible"
    for _ in range(rng.randrange(4)):
        if depth < 5 and rng.random() < 0.6:
            inner, seen = _made(rng, depth + 1, shown, displayed)
            page += inner
            words += seen
        else:
            word = f"w{rng.randrange(10**6)}"
            page += f" {word} "
            words += [word] * (shown and displayed)
    tag = rng.choice(["div", "span", "p", "ul", "section"]) if depth else "div"
    tag = "div" if "<" in page and tag == "p" else tag
    return f"<{tag} style='{style}'>{page}</{tag}>", words


def test_made_pages_by_a_plain_walk():
    rng = random.Random(0)
    for _ in range(400):
        page, words = _made(rng)
        assert html_text.render(page).split() == words, page


@pytest.mark.parametrize("depth", [10, 300, 20_000])
def test_rules_hold_at_any_depth(depth):
    deep = "<font>" * depth
    assert html_text.render(f"{deep}a<div style='display:none'>no<p hidden>no</p>no</div><noscript>no</noscript>b") == "ab"
    assert html_text.render(f"<div hidden>{deep}<div>no</div>no</div>a") == "a"
    assert html_text.render(f"<b>{deep}<ol><li>x<li>y</ol><pre> k  k</pre><table><tr><td>a<td>b</table>") == "1. x\n2. y\n\n k  k\n\na | b"
    assert html_text.render("<table><tr><td>" * min(depth, 2000) + "a<td>b") == "a | b"


class _Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_query_keeps_every_visible_word(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in table(spark, sf_dir, "pages").collect()}
    rows = queries.op9_html_layout(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == html_text.render(pages[r["page_id"]])
        plain = _Words()
        plain.feed(pages[r["page_id"]])
        plain.close()
        ours = re.sub(r"(?m)^ *\* ", "", r["text"])
        assert re.sub(r"\s", "", ours) == re.sub(r"\s", "", "".join(plain.words))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>x"), (3, "<ul>" * 3000 + "deep"), (4, "<p>word " * 20000), (4, "<p>word " * 20000), (5, "<title>T &amp; U</title>b")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, html string, text string, n_lines int")
    found = html_text.extract(df).collect()
    assert [r["page_id"] for r in found] == [r[0] for r in rows]
    assert [(r["title"], r["text"], r["n_lines"]) for r in found[:3]] == [(None, "", 0), (None, "", 0), (None, "x", 1)]
    assert found[3]["text"].strip() == "deep" and found[4]["text"].count("word") == 20000 and found[4] == found[5]
    assert found[6]["title"] == "T & U" and found[6]["text"] == "b"
    assert html_text.extract(df.limit(0)).count() == 0
