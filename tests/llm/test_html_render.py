import re
from html.parser import HTMLParser

import pytest
from flowlens.llm.html_render import render_html, render_pages
from hypothesis import given, settings
from hypothesis import strategies as st

CASES = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("a<div>b</div>c", "a\nb\nc"),
    ("<b>x</b>y <i> z</i>", "xy z"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a<p>b</p><li>c</ol>", "9. a\n\n   b\n\n10. c"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3</table>", "Name       Qty\napple pie  3"),
    ("<table><tr><td>a<br>bb<td>c<tr><td colspan=2>a wide cell<tr><td>d<td>e</table>", "a   c\nbb\na wide cell\nd   e"),
    ("t<table><tr><td><table><tr><td>in</table></table>u", "t\n\nin\n\nu"),
    ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"),
    ("<p hidden>x</p><p style='color:red;display: none'>y</p><style>.ad, #m{display:none}</style><i class='q ad'>z</i><b id=m>w</b>k", "k"),
    ("<head><title>t</title></head><script>if(a<b)</script><!-- <p>c --><template>t</template>v", "v"),
    ("<details><summary>s</summary>no</details><details open><summary>s</summary>yes</details><dialog>d</dialog>", "s\ns\nyes"),
    ("a &amp; b &lt;p&gt; &copy;", "a & b <p> ©"),
    ("a < b <3 </x> <unfinished", "a < b <3 <unfinished"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("</p></div>x</table>", "x"),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("page,want", CASES)
def test_cases(page, want):
    assert render_html(page) == want


class Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.depth -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def test_all_visible_text_of_the_pages(spark):
    """Against the standard library's parser, white space and markers aside."""
    for r in render_pages(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect():
        parser = Visible()
        parser.feed(r.html)
        parser.close()
        assert "".join("".join(parser.out).split()) == "".join(re.sub(r"(?m)^\s*- ", "", r.text).split())


PIECES = ["<p>", "</p>", "<div>", "</div>", "<table>", "</table>", "<tr>", "<td>", "</td>", "<li>", "<ul>", "</ul>", "<b>", "</b>", "<pre>", "</pre>", "x ", "\n", "yy", "<br>", "< ", "&lt;", "<th colspan=3>", "<caption>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30))
def test_broken_markup_keeps_its_text(pieces):
    text = render_html("".join(pieces))
    assert sorted(c for c in text if c in "xy<") == sorted("".join("<" if p in ("< ", "&lt;") else p for p in pieces if p in ("x ", "yy", "< ", "&lt;")).replace(" ", ""))


def test_depth_and_awkward_rows(spark):
    deep = "<div>" * 5000 + "x" + "<ul><li>" * 3000 + "y"
    wide = "<p>" + "word " * 200_000
    rows = [(1, deep, "mine"), (2, wide, "mine"), (2, wide, "mine"), (None, None, None), (3, "", "mine")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = render_pages(pages)
    assert out.columns == ["page_id", "html", "text", "_text"]
    by = {r.page_id: r._text for r in out.collect()}
    assert by[1].split()[0] == "x" and by[1].endswith("y") and by[2].count("word") == 200_000 and by[None] == by[3] == ""
    assert render_pages(pages.limit(0)).count() == 0


NAV = "<nav class='n'>menu</nav><p class='noprint'>x</p>"
STYLED = [
    ("<style>@media print { .noprint { display:none } } @media (max-width:600px){nav{display:none}}</style>" + NAV, "menu\n\nx"),
    ("<style media=print>nav{display:none}</style><style media='screen'>.noprint{display:none}</style>" + NAV, "menu"),
    ("<style>@media screen and (min-width: 50em), print { nav{display:none} }</style>" + NAV, "x"),
    ("<style>@media not screen{nav{display:none}} @media (width < 700px){p{display:none}} @media (400px <= width){.n{display:none}}</style>" + NAV, "x"),
    ("<style>@media all{@supports (display:grid){@media print{p{display:none}} nav{display:none}}} @import url(x);</style>" + NAV, "x"),
    ("<style>@media (prefers-color-scheme: dark){nav{display:none}} @font-face{src:url(x)} @keyframes p{from{display:none}}</style>" + NAV, "menu\n\nx"),
    ("<style>nav{display:none} nav{display:block}</style>" + NAV, "menu\n\nx"),
    ("<style>nav{display:none!important} nav{display:block} .noprint{display:none} p{display:block}</style>" + NAV, ""),
    ("<style>.n{display:none} /* p{display:none} */ p::after{content:'}p{display:none}'}</style><nav class=n style='display:flex'>menu</nav><p>x", "menu\n\nx"),
    ("<style>.t{visibility:hidden} .v{visibility:visible}</style><div class=t>no <b class=v>yes</b> no<i style='visibility: visible'>s</i></div>", "yess"),
    ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b<li><i style='visibility:visible'>c</i></ul>", "- b\n  c"),
    ("<table style='visibility:hidden'><tr><td>aa<td style='visibility:visible'>b<tr style='visibility:visible'><td>cc<td>d</table>", "    b\ncc  d"),
    ("<style>.s{display:block}</style><p hidden class=s>shown</p><p hidden>not</p>", "shown"),
]


@pytest.mark.parametrize("page,want", STYLED)
def test_styles(page, want):
    assert render_html(page) == want


def seconds(call, *args):
    import time

    began = time.time()
    call(*args)
    return time.time() - began


def test_a_megabyte_of_broken_tags_takes_linear_time():
    for piece in ('<a x="', "<a b ", "<a x='\"", "<", "<a<b", "<p <", "<b>", "</b>", "<td>", "&", "<a b='c' "):
        assert seconds(render_html, piece * (1_000_000 // len(piece))) < 6, piece


def test_hidden_text_stays_hidden_at_any_depth():
    for depth in (50, 250, 5000):
        page = "<div>" * depth + "<p style='display:none'>secret<b>too</b></p><p>shown</p>" + "</div>" * depth + "after"
        assert render_html(page).split() == ["shown", "after"]


def test_cells_that_span_rows_keep_their_columns():
    page = "<table><tr><td rowspan=2>A<td>b1<tr><td>b2<tr><td>c<td>d</table>"
    assert render_html(page) == "A  b1\n   b2\nc  d"
    late = "<table><tr><td>x<td rowspan=0>y<td>z<tr><td>u<td>v<tr><td>w</table>"
    assert render_html(late) == "x  y  z\nu     v\nw"


def test_tables_are_not_blown_up():
    wide = "<table>" + "".join(f"<tr><td>{'x' * 20_000 if i == 0 else 'y'}<td>{i}" for i in range(500)) + "</table>"
    out = render_html(wide)
    assert len(out) < 2 * len(wide) and out.split("\n")[1] == "y  1"
    tall = "<table><tr><td>" + "<br>".join("line" for _ in range(5000)) + "".join("<td>c" for _ in range(500)) + "</table>"
    assert len(render_html(tall)) < 2 * len(tall) and render_html(tall).split() == ["line"] * 5000 + ["c"] * 500
    spread = "<table>" + "<tr>" + "<td colspan=1000 rowspan=1000>a" * 300 + "<tr><td>b" * 300 + "</table>"
    assert len(render_html(spread)) < 20 * len(spread)
    quotes = "<blockquote>" * 3000 + "<br>".join("q" for _ in range(3000))
    assert len(render_html(quotes)) < 20 * len(quotes)
