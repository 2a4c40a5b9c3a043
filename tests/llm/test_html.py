"""Visible text of pages: implied tags, visibility, lists, tables, odd markup."""

import pytest

from areaflow.llm import html_text

CASES = {
    "<p>a<p>b  c\n d": "a\n\nb c d",
    "<ul><li>x<li>y<ol start=3><li>q</ol></ul>z": "- x\n- y\n  3. q\n\nz",
    "<table><caption>C<tr><th>h1<th>h2<tr><td>aaaa<td>b<br>c</table>": "C\nh1   | h2\naaaa | b\n     | c",
    "<table><tr><td colspan=2>wide<tr><td>a<td>b</table>": "wide\na | b",
    "a<div hidden>no</div><div style='display:none'>no</div><span style='visibility: hidden'>no</span>b": "ab",
    "<head><title>t</title><style>x{}</style></head><body>seen<script>if (a<b) {}</script></body>": "seen",
    "<title>t</title>seen": "seen",
    "<pre>\n  k\n   l\n</pre>": "  k\n   l",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "one &amp; two &#233; &nosuch; <b>bo</b>ld": "one & two é &nosuch; bold",
    "<h1>t</h1>x<hr>y": "t\n\nx\n---\ny",
    "<blockquote>q<p>r</blockquote>": "> q\n>\n> r",
    "<dl><dt>k<dd>v<dt>l<dd>w</dl>": "k\n    v\nl\n    w",
    "<img alt='pic'> <!-- no --> <select><option>a<option>b</select>end": "pic end",
    "</p></div>x</table>y": "xy",
    "a < b <": "a < b <",
    "": "",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert html_text.visible_text(html) == CASES[html]


def test_wide_and_combining_characters_keep_columns():
    lines = html_text.visible_text("<table><tr><td>日本<td>x<tr><td>ée<td>y<tr><td>abcd<td>z</table>").split("\n")
    assert len({html_text.width(x.split("|")[0]) for x in lines}) == 1


def test_deep_and_long_pages():
    assert html_text.visible_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert html_text.visible_text("<b>" * 3000 + "x<p>y").split() == ["x", "y"]
    assert len(html_text.visible_text("<p>word</p>" * 20000).split()) == 20000


def test_table_of_pages(frame):
    pages = frame("page_id long, html string, visible_text string", (1, None, "own"), (None, "", "own"), (1, "<p>x", "own"), (1, "<p>x", "own"))
    got = [r["visible_text"] for r in html_text.extract(pages).collect()]
    assert got == [None, "", "x", "x"]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_text_and_inline_elements_end_an_open_head():
    from areaflow.llm.html_text import visible_text

    head = "<head><title>t</title> <meta charset=utf-8><style>p {}</style><script>x</script>"
    assert visible_text(head + "Hello <b>x</b>") == "Hello x"
    for body in ("<a href=u>x</a>", "<span>x</span>", "<img alt=x>", "<br>x", "<b>x</b>"):
        assert visible_text(head + body) == "x"
    assert visible_text(head + "<li>x").endswith("x") and visible_text(head + "<table><tr><td>x") == "x"
    assert visible_text(head + "</head><body>y") == "y" and visible_text(head) == ""
