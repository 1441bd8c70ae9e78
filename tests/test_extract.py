from presslake.operators.extract import (
    extract_articles,
    extract_legacy,
    extract_links,
    links_per_page,
    pick_nodes,
)
from presslake.operators.extract import ARCHIVE_CONTAINER, ARCHIVE_RULES
from test_html import PAGE

BASE = "https://www.example.com/a/b"


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, html string, category string")


def test_article_row(spark):
    rows = extract_articles(pages(spark, (BASE, PAGE, "c"), (BASE, "<p>divcont</p>", "c"), (BASE, None, "c")), "example.com")
    (row,) = rows.collect()
    assert (row.article_id, row.url, row.category) == ("77", BASE, "c")
    # the first direct text node of a heading decides, even when it is blank
    assert (row.title, row.publish_date, row.author) == ("", "d", "w")
    assert row.content == "x"
    assert row.tags == ["t1", "t2"]
    assert [tuple(m) for m in row.media] == [
        ("image", "/1.jpg", "A", "cap", "external"),
        ("image", "/2.jpg", None, "t2", "external"),
        ("video", "/v", None, None, "external"),
        ("video", "/v.mp4", None, None, "external"),
        ("audio", "https://www.example.com/a/s.ogg", None, None, "internal"),
        ("audio", "https://www.example.com/a/x.mp3", None, None, "internal"),
    ]


def test_category_default_and_missing_id(spark):
    html = '<div id="divcont"><h1>t</h1></div>'
    (row,) = extract_articles(pages(spark, (BASE, html, None)), "example.com").collect()
    assert (row.article_id, row.category, row.title, row.content, row.tags, row.media) == (
        None, "unknown", "t", "", [], []
    )
    no_category = pages(spark, (BASE, html, None)).drop("category")
    assert extract_articles(no_category, "example.com").collect()[0].category == "unknown"


def test_media_first_wins_across_types_and_empty_sources(spark):
    html = """<div id="divcont"><div id="articleBody"><img src=""><img src="u" title=""><img src="u" title="x"></div>
      <iframe src="u"></iframe><iframe src=""></iframe><video src="v"></video>
      <audio src="https://h/a.mp3"></audio></div><a href="https://h/a.mp3">"""
    (row,) = extract_articles(pages(spark, (BASE, html, "c")), "example.com").collect()
    assert [(m.type, m.url, m.caption) for m in row.media] == [
        ("image", "u", None), ("video", "v", None), ("audio", "https://h/a.mp3", None)
    ]


def test_legacy_row(spark):
    html = """<div id="divcont" data-id="9"><h1> t </h1><div class="img-cont"><img alt="A"><img src="f" alt="B">
      <p class="img-cap">c</p></div><div id="articleBody">skip<p> a </p><p>b<b>no</b></p>
      <img src="f" title="again"><img src="/LOGO.png"><img src="g" title="tg"></div></div>"""
    rows = extract_legacy(pages(spark, (BASE, html, "c"), ("u2", "<p>x</p>", "c"))).collect()
    row = next(r for r in rows if r.url == BASE)
    assert (row.article_id, row.title, row.author, row.content) == ("9", "t", None, "a  b")
    assert [tuple(i) for i in row.images] == [("f", "A", "c", "featured"), ("g", None, "tg", "body_gallery")]
    other = next(r for r in rows if r.url == "u2")
    assert (other.article_id, other.title, other.images, other.tags) == (None, None, [], [])


def test_links(spark):
    html = '<div class="bigOneSec"><h3><a href="/x">1</a><a>2</a></h3><h3><a href="/x">3</a></h3></div>'
    df = pages(spark, (BASE, html, "c"), ("https://e.org/", "<p>", "c"))
    got = [(r.pos, r.link) for r in extract_links(df, keep=["url"]).orderBy("pos").collect()]
    assert got == [(0, "https://www.example.com/x"), (1, "https://www.example.com/x")]
    counts = {r.url: r.n_links for r in links_per_page(df, keep=["url"]).collect()}
    assert counts == {BASE: 2, "https://e.org/": 0}


def test_container_selectors_of_any_form(spark):
    """Upper-case tags and compound selectors: no page with the container is lost."""
    rule = ARCHIVE_RULES[1]
    html = {
        "article": "<ARTICLE><H1>t</H1></ARTICLE>",
        "div.main": '<div class="x main"><h1>t</h1></div>',
        "div#m": "<DIV ID=m><h1>t</h1></DIV>",
        ".main": "<p class='main'><h1>t</h1></p>",
    }
    for container, page in html.items():
        assert pick_nodes(pages(spark, ("u", page, "c")), (rule,), container).count() == 1, container
    assert pick_nodes(pages(spark, ("u", "<p>x</p>", "c")), (rule,), "div.main").count() == 0
