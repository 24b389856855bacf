"""Layout of hand-written pages, all visible words of the given pages, and odd rows."""

import random
import re
from html.parser import HTMLParser

import pytest

from fieldpulse.llm import page_text
from fieldpulse.llm.page_text import text_of, tree_of
from fieldpulse.llm.page_text import extract
from fieldpulse.llm.queries import QUERIES
from tests.conftest import SMALLEST

PAGES = {
    "blocks": ("<h1>T</h1><p>a  b\n c<p>d<div>e</div>f", "T\n\na b c\n\nd\n\ne\nf"),
    "breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "inline": ("a<b>b</b> <i>c</i>d", "ab cd"),
    "list": ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    "ordered": ("<ol start=9><li>a<li>b<li value=20>c</ol>", "9. a\n10. b\n20. c"),
    "letters": ("<ol type=a start=26><li>x<li>y</ol><ol type=I><li>p<p>q</ol>", "z. x\naa. y\n\nI. p\n\n   q"),
    "reversed": ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    "terms": ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
    "table": ("<table><tr><th>name<th>n<tr><td>ab cd<td>1<tr><td>e<td>22</table>", "name   n\nab cd  1\ne      22"),
    "spans": (
        "<table><caption>C</caption><tr><td colspan=2>wide one<td>x<tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>",
        "C\nwide one  x\na  b      c\n   d      e",
    ),
    "sections": ("<table><tfoot><tr><td>f</tfoot><tbody><tr><td>b<thead><tr><td>h</table>", "h\nb\nf"),
    "right": ("<table><tr><td align=right>1<td>a<tr><td align=right>200<td>b</table>", "  1  a\n200  b"),
    "cell blocks": ("<table><tr><td>a<br>b<td><ul><li>x<li>y</ul></table>", "a  - x\nb  - y"),
    "nested": ("<table><tr><td>o<td><table><tr><td>i<td>j<tr><td>kk<td>l</table></table>", "o  i   j\n   kk  l"),
    "wide signs": ("<table><tr><td>日本<td>a<tr><td>abcd<td>b</table>", "日本  a\nabcd  b"),
    "misplaced": ("<table>before<tr><td>cell</table>", "before\n\ncell"),
    "pre": ("<pre>\n a\n\n  b</pre>c", " a\n\n  b\n\nc"),
    "quote": ("a<blockquote>b<p>c</blockquote>", "a\n\n  b\n\n  c"),
    "hidden": ("<p hidden>a<p style='display : none'>b<p>c<span style=visibility:hidden>d<i style=visibility:visible>e</i></span>", "ce"),
    "raw": ("<script>if (a<b) '</p>'</script>x<style>y</style><noscript>z</noscript><template>t</template>", "x"),
    "head": ("<head><title>T &amp; x</title><meta charset=utf-8></head><body>b", "b"),
    "no head end": ("<head><title>T</title><p>b", "b"),
    "details": ("<details>a<summary>s</summary>b<p>c</details><details open><summary>t</summary>d</details>", "s\nt\nd"),
    "entities": ("a &lt;b&gt; &amp &eacute;&#x41;&nbsp;c", "a <b> & éA c"),
    "comment": ("a<!-- x > <b> -->b<!---->c<!doctype html>d<?x y?>e", "abcde"),
    "broken": ("a < b <3 <p title='x>y'>c</i></div>d<a href=\"q>e", "a < b <3\n\ncde"),
    "ends": ("a</p>b</br>c", "a\n\nb\nc"),
    "part": ("<td>a</td><tr>b", "ab"),
    "options": ("<select><option>a<option>b</select>", "a\nb"),
    "empty item": ("<ul><li><li>a</ul>", "- a"),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_layout(name):
    page, text = PAGES[name]
    assert text_of(page) == text


def test_deep_nesting():
    assert text_of("<div>" * 20_000 + "a" + "</div>" * 20_000 + "<ul><li>" * 3_000 + "b").split() == ["a", *"-" * 3000, "b"]
    assert len(tree_of("<b>" * 5_000).children) == 1


class _Words(HTMLParser):
    """Text outside head, script and style, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.hidden, self.found = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("head", "script", "style")
        if tag not in ("a", "b"):
            self.found.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("head", "script", "style")
        if tag not in ("a", "b"):
            self.found.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.found.append(data)


@pytest.mark.parametrize("folder", [SMALLEST, "/root/testdata/sf0.01"])
def test_query_has_every_visible_word(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op7_page_text"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        parser = _Words()
        parser.feed(pages[r.page_id] or "")
        parser.close()
        assert [w for w in r.text.split() if w != "-"] == [w for w in "".join(parser.found).split() if w != "-"]
        assert r.n_chars == len(r.text) and not re.search(r"[ \t]\n|\n\n\n", r.text)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "<p>a", "x"), (3, "<p>a", "x"), (None, "b\x00c" * 3, "x")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = sorted(((r.page_id or 0), r.n_chars, r.text) for r in extract(frame).collect())
    assert found == [(0, 6, "bcbcbc"), (1, 0, ""), (2, 0, ""), (3, 1, "a"), (3, 1, "a")]
    assert extract(frame.limit(0)).count() == 0


@pytest.mark.parametrize("size", [100_000, 1_000_000])
@pytest.mark.parametrize("quote", ["'", '"'])
def test_long_attributes_do_not_leak(size, quote):
    other = '"' if quote == "'" else "'"
    value = ("a > b " + other + "<p>" + "x" * 50) * (size // 60)
    page = f"<p>one</p><img alt={quote}{value}{quote} hidden><p>two</p>"
    assert page_text.text_of(page) == "one\n\ntwo"


def test_quotes_that_never_end():
    assert page_text.text_of('<p>one</p><img alt="x > y"><p>two') == "one\n\ntwo"
    assert page_text.text_of('<p>one</p><b title="x>two</b> three') == "one\n\ntwo three"
    assert page_text.text_of("<p>one</p><b title='x>two \"quoted\"</b> three") == 'one\n\ntwo "quoted" three'
    assert page_text.text_of('<a title="x') == ""


def test_many_open_quotes_are_read_in_linear_time():
    from time import process_time

    def seconds(many):
        began = process_time()
        page_text.tree_of("<a b='\"" * many + "<i x=\"y 'z\"" * many)
        return process_time() - began

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.02)


def tag_ends(page, at):
    """The same by a look at every sign."""
    quote = ""
    for i in range(at, len(page)):
        if quote:
            quote = "" if page[i] == quote else quote
        elif page[i] == ">":
            return i
        elif page[i] in "\"'":
            quote = page[i]
    return -1


def test_tag_ends_equal_a_plain_walk():
    pick = random.Random(8)
    for _ in range(300):
        page = "".join(pick.choice("ab<>\"'  ") for _ in range(pick.randint(0, 60)))
        ends = page_text._TagEnds(page)
        for at in sorted(pick.sample(range(len(page) + 1), min(len(page), 12))):
            assert ends.find(at) == tag_ends(page, at), (page, at)
