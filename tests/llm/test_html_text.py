import random

import pytest

from presslake.llm.html_text import extract_text, visible_text

PAGES = {
    "implied tags": ("<title>t</title><p>one<p>two<ul><li>a<li>b</ul>three", "one\n\ntwo\n\n- a\n- b\n\nthree"),
    "blocks and inline": ("<div>a <b>bold</b>\n  text<div>inner</div>tail</div>", "a bold text\ninner\ntail"),
    "headings": ("<h1>Title</h1><p>Text</p><hr><p>End</p>", "Title\n\nText\n\n---\n\nEnd"),
    "line breaks": ("a<br>b<br/>c", "a\nb\nc"),
    "nested lists": (
        "<ol start=3><li>x<ul><li>y<li>z</ul><li>w</ol>",
        "3. x\n   - y\n   - z\n4. w",
    ),
    "table": (
        "<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>b<td>22</table>",
        "Name      | N\nlong name | 1\nb         | 22",
    ),
    "spanning and empty cells": (
        "<table><tbody><tr><td colspan=2>ab</td><td>c</td></tr><tr><td>1</td><td></td><td>3</td></tr></table>",
        "ab |  | c\n1  |  | 3",
    ),
    "cell lines": ("<table><tr><td>a<br>b<td>c</table>", "a | c\nb |"),
    "preformatted": ("<p>x</p><pre>  if a:\n    b\n</pre>", "x\n\n  if a:\n    b"),
    "hidden": (
        "<style>.no, #gone {display: none} p.x{color:red}</style><p class='a no'>1</p><p id=gone>2</p>"
        "<p hidden>3</p><p style='DISPLAY : none'>4</p><p class=x>5</p><script>var a='<p>6</p>'</script>"
        "<template>7</template><!-- 8 --><noscript>9</noscript><p style='visibility:hidden'>10",
        "5",
    ),
    "entities": ("<p>a &lt;b&gt; &amp; &eacute;&#33;&nbsp;c", "a <b> & é!\u00a0c"),
    "head": ("<html><head><title>no</title><meta charset=x></head><body>yes</body></html>", "yes"),
    "no head end": ("<head><title>no</title><p>yes", "yes"),
    "stray ends": ("</div>a</b><b>b</i>c</p>d", "abc\n\nd"),
    "alt text": ("<p>see <img alt='the picture' src=x> here", "see the picture here"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
    "broken": ("<p <b>x</p><", "x\n\n<"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_layout(name):
    html, text = PAGES[name]
    assert visible_text(html) == text


MALFORMED_TABLES = {
    "form between rows": ("<table><tr><td>a</td></tr><form><tr><td>y</td></tr></form></table>", "a\ny"),
    "form in a row": ("<table><tr><form><td>A</td></form><td>B</td></tr></table>", "A | B"),
    "outer form": ("<form><table><tr><td>a</td></tr></form><tr><td>y</td></tr></table></form>", "a\ny"),
    "text and block after a row": ("<table><tr><td>a</td></tr>x<div>y</div><tr><td>b</td></tr></table>", "x\ny\n\na\nb"),
    "text in a row": ("<table><tr>x<td>a</td> z</tr></table>", "x z\n\na"),
    "open block in a row": ("<table><tr><div>x<td>a</td><td>b</td></tr></table>", "x\n\na | b"),
}


@pytest.mark.parametrize("name", MALFORMED_TABLES)
def test_malformed_tables_keep_their_text(name):
    html, text = MALFORMED_TABLES[name]
    assert [line for line in visible_text(html).split("\n") if line] == [line for line in text.split("\n") if line]


SPANS = {
    "rows": ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A | B\n  | C"),
    "rows at the end": ("<table><tr><td>A<td rowspan=3>B<tr><td>C<tr><td>D</table>", "A | B\nC |\nD |"),
    "rows and columns": ("<table><tr><td rowspan=2 colspan=2>A<td>B<tr><td>C<tr><td>1<td>2<td>3</table>", "A |   | B\n  |   | C\n1 | 2 | 3"),
    "rest of a group": ("<table><tbody><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D<td>E</table>", "A | B\n  | C\nD | E"),
    "not past its group": ("<table><thead><tr><th rowspan=9>A<th>B<tbody><tr><td>C<td>D</table>", "A | B\nC | D"),
}


@pytest.mark.parametrize("name", SPANS)
def test_cells_over_several_rows(name):
    html, text = SPANS[name]
    assert visible_text(html) == text


DRAWN = {
    "closed details": ("<details><summary>more</summary>gone<p>too</details>b", "more\nb"),
    "open details": ("<details open><summary>more</summary>here</details>b", "more\nhere\nb"),
    "details without summary": ("a<details>gone</details>b", "a\nb"),
    "inputs": (
        "<input value=text><input type=password value=no><input type=radio value=no> <input type=CHECKBOX value=no>"
        "<input type=image alt=go value=no> <input type=submit value=send>",
        "text go send",
    ),
    "progress": ("<p>at <progress value=1 max=2>50%</progress><meter value=1>one</meter>end", "at end"),
    "numbered items": ("<ol><li>a<li value=7>b<li>c<li value=x>d</ol>", "1. a\n7. b\n8. c\n9. d"),
    "reversed items": ("<ol reversed><li>a<li>b</ol><ol reversed start=9><li>c<li>d</ol>", "2. a\n1. b\n\n9. c\n8. d"),
    "ends of comments": ("a<!-- x --!>b<!-->c<!--->d<!-- y -- > z -->e", "abcde"),
    "open comment": ("a<!-- b", "a"),
}


@pytest.mark.parametrize("name", DRAWN)
def test_what_a_browser_draws(name):
    html, text = DRAWN[name]
    assert visible_text(html) == text


STYLES = {
    "print only": ("<style>@media print { .nav { display: none } }</style><p class=nav>a", "a"),
    "print sheet": ("<style media=print>.nav{display:none}</style><p class=nav>a", "a"),
    "small screens": ("<style>@media (max-width:600px){.w{display:none}} .n{display:none}</style><p class=w>a<p class=n>b", "a"),
    "every screen": ("<style>@media screen { .nav { display: none } }</style><p class=nav>a<p>b", "b"),
    "not print": ("<style>@media not print{.a{display:none}} @media not screen{.b{display:none}}</style><p class=a>a<p class=b>b", "b"),
    "shown again": ("<style>.tab{display:none} .tab{display:block}</style><p class=tab>a", "a"),
    "hidden later": ("<style>.tab{display:block} .tab{display:none}</style><p class=tab>a<p>b", "b"),
    "shown by a second class": ("<style>.tab{display:none}.tab.active{display:block}</style><p class='tab active'>a<p class=tab>b", "a"),
    "shown by rank": ("<style>#x{display:block} p{display:none}</style><p id=x>a<p>b", "a"),
    "important": ("<style>.t{display:none!important}.t.u{display:block}</style><p class='t u' style='display:block'>a<p>b", "b"),
    "shown by its attribute": ("<style>.t{display:none}</style><p class=t style='display:block'>a", "a"),
    "pseudo-element": ("<style>.t{display:none}.t:after{display:block}.t:hover{display:block}</style><p class=t>a<p>b", "b"),
    "braces in strings": ("<style>.q:before{content:'}{'} .t{display:none}</style><p class=t>a<p>b", "b"),
    "not closed": ("<style>@media screen{.t{display:none</style><p class=t>a<p>b", "b"),
    "options": ("<select><option>one<option>two</select>", "one\ntwo"),
    "textarea": ("<textarea>\na  b\nc</textarea>", "a  b\nc"),
    "drawing": ("<p>x<svg><title>no</title><path d='M0'/>no<g><text>A <tspan>b</tspan></text></g><defs><text>no</text></defs></svg>", "x\nA b"),
    "formula": ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>", "so x=2"),
}


@pytest.mark.parametrize("name", STYLES)
def test_only_what_no_screen_draws_is_hidden(name):
    html, text = STYLES[name]
    assert visible_text(html) == text


def test_damaged_pages_never_fail():
    rng = random.Random(3)
    parts = [p for group in (PAGES, MALFORMED_TABLES, SPANS, DRAWN, STYLES) for p, _ in group.values()]
    bits = ["<", ">", "'", '"', "<!--", "--", "rowspan=", "colspan=-4", "\x00", "\u00b2", "&#x110000;", "&#99999999999;", "{", "}", "@media", "</table>", "<td>", "<ol start="]
    for _ in range(20_000):
        page = list(rng.choice(parts) + rng.choice(parts))
        for _ in range(rng.randint(1, 8)):
            at = rng.randrange(len(page) + 1)
            page[at : at + rng.choice((0, 0, 1, 5))] = rng.choice(bits)
        assert isinstance(visible_text("".join(page)), str)


@pytest.mark.parametrize("tag", ["div", "font", "blockquote"])
def test_deep_pages_are_laid_out(tag):
    inner = (
        "<script>var a = 1</script><p>x<p style='display:none'>gone</p><ul><li>i</ul>"
        "<table><tr><td>long name<td>1<tr><td>b<td>22</table>"
    )
    shallow = visible_text(f"<head><title>no</title></head>{inner}")
    deep = visible_text(f"<head><title>no</title></head>{f'<{tag}>' * 3000}{inner}")
    assert [line.strip() for line in deep.split("\n")] == shallow.split("\n")


def test_deep_tables_are_laid_out():
    html = "<table><tr><td>" * 600 + "a<script>no</script>" + "</table>" * 600
    assert visible_text(html) == "a"


def test_rows(spark):
    deep = "<div>" * 3000 + "bottom"
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "u", ""), (3, "u", deep), (4, "u", "<p>w " * 50_000)]
    found = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")).collect()
    texts = [r.text for r in found]
    assert texts[:4] == ["a", "a", None, ""]
    assert "bottom" in texts[4] and texts[5].count("w") == 50_000
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_numbers_that_are_none():
    for start in ("--5", "\u00b2", "9" * 5000, "", "x", "1.5"):
        assert visible_text(f'<ol start="{start}"><li>a</ol>').split() == ["1.", "a"]
        visible_text(f'<table><tr><td colspan="{start}">a<td>b</table>')
    assert visible_text('<ol start="-3"><li>a</ol>').split() == ["-3.", "a"]
