"""The page helper on small documents; no Spark involved."""

from presslake.functions.html import PagePicker, Rule
from presslake.operators.extract import (
    ARCHIVE_CONTAINER,
    ARCHIVE_RULES,
    LISTING_LINKS,
    SECTION_LINKS,
)

BASE = "https://www.example.com/a/b"


def pick(html, *rules, container=None):
    return PagePicker(rules, container).pick(html, BASE)


def texts(html, selector, how="text", container=None):
    return pick(html, Rule("x", (selector,), how), container=container)["x"]


def test_direct_and_deep_text():
    html = "<div id=a>one<p>two <b>three</b> four</p><!-- c -->five</div>"
    assert texts(html, "#a") == ["one", "five"]
    assert texts(html, "#a", "deep") == ["one", "two ", "three", " four", "five"]
    assert texts(html, "#a p") == ["two ", " four"]


def test_comments_and_elements_end_a_text_node_but_stray_end_tags_do_not():
    assert texts("<p>a<!-- -->b<br>c</i>d</p>", "p") == ["a", "b", "cd"]


def test_script_and_style_are_text_without_entities():
    html = '<div id=a><script>if (a < b && "</p>") {}</script><style>p{}</style>&lt;x&amp;</div>'
    assert texts(html, "#a", "deep") == ['if (a < b && "</p>") {}', "p{}", "<x&"]


def test_unclosed_paragraphs_and_inline_elements():
    html = "<article><p><b>one<br><p>two</p><p>three</article>after"
    assert texts(html, "article", "deep") == ["one", "two", "three"]
    assert texts("<div id=a><span>x</div><p>y", "#a", "deep") == ["x"]
    assert texts("<p><div id=a>x</p>y</div>", "#a", "deep") == ["x", "y"]


def test_attributes_quotes_case_and_repeats():
    html = """<A HREF='/1'>x</A><a href=/2 href="/3">y</a><a href="/4?a=1&amp;b=2" data-x='>'>z</a><a>n</a>"""
    rule = Rule("x", ("a",), ("href",))
    assert pick(html, rule)["x"] == ["/1", "/2", "/4?a=1&b=2"]


def test_classes_chains_and_union_in_document_order():
    html = (
        '<h3><a href="1"></a></h3><div class="x news-dev8"><p><a href="2"></a><h3><a href="3"></a></h3></p></div>'
        '<div class="bigOneSec"><section><h3><i><a href="4"></a></i></h3></section></div><a href="5"></a>'
    )
    assert pick(html, Rule("x", SECTION_LINKS, ("href",)))["x"] == ["1", "2", "3", "4"]
    assert pick(html, Rule("x", LISTING_LINKS, ("href",)))["x"] == ["4"]


def test_links_are_resolved():
    hrefs = ["/x", "y", "../z", "//h/q", "?p=1", "#f", "", "https://o/1", "mailto:a@b"]
    html = "".join(f'<a href="{h}">' for h in hrefs)
    assert pick(html, Rule("x", ("a",), ("href",), resolve=True))["x"] == [
        "https://www.example.com/x",
        "https://www.example.com/a/y",
        "https://www.example.com/z",
        "https://h/q",
        "https://www.example.com/a/b?p=1",
        "https://www.example.com/a/b#f",
        "https://www.example.com/a/b",
        "https://o/1",
        "mailto:a@b",
    ]
    based = '<base href="https://cdn.example.com/k/"><a href="y"></a>'
    assert pick(based, Rule("x", ("a",), ("href",), resolve=True))["x"] == ["https://cdn.example.com/k/y"]


def test_broken_markup_does_not_fail():
    for html in (None, "", "<", "<a", "a < b > c", "<a href='x>y", "</div></div>", "<!--", "<![CDATA[x", "<p/><br/>", "\x00<b>"):
        PagePicker(ARCHIVE_RULES, ARCHIVE_CONTAINER).pick(html, None)


PAGE = """<html><body><h1>outside</h1>
<div id="divcont" class=k><span data-id="77"></span><h1> <i>no</i> Title </h1><h1>second</h1>
<span class="newsStoryDate"> d </span><span class="writeBy">w</span>
<div class="img-cont"><img src="/1.jpg" alt="A"><span class="img-cap">cap</span></div>
<div id="articleBody"><p>x</p><div class="imgcontainer"><img src="/2.jpg" title="t2"></div><img src="/1.jpg"><img></div>
<div class="tags"><h3><a>t1</a></h3><h3><a> t2 </a></h3><h3><b><a></a></b></h3></div>
<video src="/v"><source src="/v.mp4"></video><audio><source src="s.ogg"></audio></div>
<a href="x.mp3"></a><div class="tags"><h3><a>other</a></h3></div></body></html>"""


def test_archive_page():
    got = PagePicker(ARCHIVE_RULES, ARCHIVE_CONTAINER).pick(PAGE, BASE)
    assert got["article_id"] == ["77"]
    assert got["title"] == [" ", " Title ", "second"]
    assert got["tags"] == ["t1", " t2 "]
    assert got["images"] == [
        ("/1.jpg", "A", None),
        ("/2.jpg", None, "t2"),
        ("/1.jpg", None, None),
        (None, None, None),
    ]
    assert got["videos"] == ["/v", "/v.mp4"]
    assert got["audio"] == ["https://www.example.com/a/s.ogg", "https://www.example.com/a/x.mp3"]
    assert PagePicker(ARCHIVE_RULES, ARCHIVE_CONTAINER).pick("<div id=other>divcont</div>", BASE) is None


def test_container_itself_counts():
    html = '<div id="divcont" data-id="5" class="writeBy">me</div>'
    got = PagePicker(ARCHIVE_RULES, ARCHIVE_CONTAINER).pick(html, BASE)
    assert (got["article_id"], got["author"]) == (["5"], ["me"])
