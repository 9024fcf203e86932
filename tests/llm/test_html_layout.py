"""Rendered pages: layouts written by hand, and all visible words against the standard library's parser."""

import re
from html.parser import HTMLParser

import pytest

from eventloom.llm.html_layout import RAW, UNSEEN, VOID, render, visible_text

CASES = [
    ("<p>a<p>b <b>c<br>d</b>", "a\n\nb c\nd"),
    ("a<div>b</div>c", "a\nb\nc"),
    ("  x \n y <i> z</i> ", "x y z"),
    ("<ul><li>x<ul><li>y<li>z</ul><li>w</ul><ol start=9><li>q<p>r<li>s</ol>t", "- x\n  - y\n  - z\n- w\n\n9. q\n\n   r\n\n10. s\n\nt"),
    ("<ol><li value=4>a<li>b</ol>", "4. a\n5. b"),
    ("<table><tr><th>Name<th>N<tr><td>al<td>1<tr><td>bertram<td>22</table>", "Name     N\nal       1\nbertram  22"),
    ("<table><tr><td rowspan=2>A<td>b<tr><td>c</table>", "A  b\n   c"),
    ("<table><tr><td colspan=2>wide cell here<td>x<tr><td>a<td>b<td>c</table>", "wide cell here  x\na  b  c"),
    ("<table><caption>Cap</caption><tbody><tr><td>日本<td>x<tr><td>abcd<td>y</table>", "Cap\n日本  x\nabcd  y"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a        b\n\nin  ner"),
    ("x<table>lost<tr><td>c</table>y", "xlost\n\nc\n\ny"),
    ("<pre> k\n  l</pre>m", " k\n  l\n\nm"),
    ("<blockquote>q<p>r</blockquote><dl><dt>T<dd>D</dl>", "    q\n\n    r\n\nT\n    D"),
    ("<div hidden>no</div><p style='display: none'>no<p>yes<span style='visibility:hidden'>no<b style='visibility:visible'>seen</b></span>", "yesseen"),
    ("<style>@media print { .side { display:none } }</style><div class=side>seen</div>", "seen"),
    ("<style>@media screen and (min-width: 600px) { .side { display:none } } @media (max-width:40em){.b{display:none}}</style><p class=side>no<p class=b>yes", "yes"),
    ("<style>.a{display:none} .a{display:block}</style><div class=a>last rule</div>", "last rule"),
    ("<style>.a{display:none}</style><div class=a style='display:block'>own style</div>", "own style"),
    ("<style>.a{display:none!important}</style><div class=a style='display:block'>no</div><p>yes", "yes"),
    ("<style>#x{display:block} .a{display:none}</style><div class=a id=x>heavier</div>", "heavier"),
    ("<style>div p{display:none} body .k i{display:none}</style><div><b><p>no</p></b></div><p>yes <b class=k><i>no</i></b></p>", "yes"),
    ("<style>ul > li{display:none} .m li{display:list-item}</style><ul><li>no</ul><ul class=m><li>yes</ul>", "- yes"),
    ("<style>[hidden]{display:none} .on{display:block} a:hover{display:none}</style><div hidden class=on>shown again</div><a>link</a>", "shown again\nlink"),
    ("<style>@font-face{font-family:x;src:url(a)} @keyframes k{from{visibility:hidden}} @supports (display:grid){.g{display:none}} @import 'x';.z{display:none</style><p class=g>no<p class=z>no<p>yes", "yes"),
    ("<style>.h, p#x {display:none}/*.y{display:none}*/</style><i class='a h'>no</i><p id=x>no</p><p id=y class=y>yes</p>", "yes"),
    ("<head><title>no</title><script>if (a<b) '</p>'</script></head><body>yes<noscript>no</noscript><template>no</template>", "yes"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details><dialog>no</dialog>", "S\nT\nyes"),
    ("a &amp; b &lt;c&gt; &copy &nosuch; &#x41;", "a & b <c> © &nosuch; A"),
    ("a < b > c <3 </ x> <!-- no --> <!doctype html><?no?> d", "a < b > c <3 d"),
    ("<a title='>'>x</a><a title=it's>y</a>", "xy"),
    ("</p>a</br>b</div></table>", "a\nb"),
    ("<h1>A<h2>B</h1>C<p>D</h2>E", "A\n\nB\n\nC\n\nDE"),
    ("<li>a<li>b", "- a\n- b"), ("<ul><li></ul>", "-"), ("<td>a<tr>b", "ab"),
    ("<textarea>\n a <b></textarea>", "\n a <b>"), ("<p>unclosed <a href='", "unclosed"), ("", ""), ("<!-- open", ""),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert render(page) == text


def test_deep_and_long_pages():
    assert render("<div>" * 100_000 + "x") == "x"
    assert render("<b>" * 50_000 + "x" + "</b>" * 50_000) == "x"
    assert render("<table><tr><td>" * 500 + "x") == "x"
    assert render("<p>" + "word " * 200_000).count("word") == 200_000


class Plain(HTMLParser):
    """Visible text in order, for pages whose tags are all closed where it matters."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            if self.hidden or tag in UNSEEN | RAW:
                self.hidden += 1
        self.out.append(" ")

    def handle_endtag(self, tag):
        if self.hidden and tag not in VOID:
            self.hidden -= 1
        self.out.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_all_visible_words_of_real_pages_in_order(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in visible_text(pages.selectExpr("page_id", "html", "'old' AS TEXT")).collect():
        plain = Plain()
        plain.feed(r.html)
        plain.close()
        words = re.sub(r"\s+", "", "".join(plain.out))
        shown = "".join(re.sub(r"^ *(?:- |\d+\. )", "", line) for line in r.text.split("\n"))
        assert re.sub(r"\s+", "", shown) == words.replace("-", "") or re.sub(r"\s+", "", shown) == words


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "<p>a")], "page_id long, html string")
    assert [(r.page_id, r.text) for r in visible_text(df).collect()] == [(1, None), (2, ""), (2, ""), (None, "a")]
    assert visible_text(df.limit(0)).count() == 0
