"""Pages to article rows, media and links.

One Python stage (Arrow batches) picks the raw nodes out of the HTML; cleaning,
joining, classification and de-duplication are Spark expressions. ``html`` never
leaves that stage, so nothing after it shuffles page bodies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

import presslake
from presslake.functions.bloom import Bloom
from presslake.functions.html import PagePicker, Rule
from presslake.functions.text import media_provider, ustrip
from presslake.operators.dedup import media_first_wins
from presslake.schema import MEDIA_DDL

# Python workers get the page helper with the task; executors need no install.
cloudpickle.register_pickle_by_value(presslake)

# Where an article page keeps its fields.
ARCHIVE_CONTAINER = "#divcont"
ARCHIVE_RULES = (
    Rule("article_id", ("*",), ("data-id",)),
    Rule("title", ("h1",), "text"),
    Rule("publish_date", (".newsStoryDate",), "text"),
    Rule("author", (".writeBy",), "text"),
    Rule("content", ("#articleBody",), "deep"),
    Rule("tags", (".tags h3 a",), "text"),
    Rule("images", (".img-cont img", "#articleBody img", ".imgcontainer img"), ("src", "alt", "title")),
    Rule("caption", (".img-cap",), "text"),
    Rule("videos", ("iframe", "video source", "video"), ("src",)),
    Rule("audio", ("audio source", "audio"), ("src",), resolve=True),
    Rule("audio", ("a",), ("href",), anywhere=True, contains=".mp3", resolve=True),
)
LEGACY_RULES = (
    *ARCHIVE_RULES[:4],
    Rule("content", ("#articleBody p",), "text"),
    Rule("tags", (".tags h3 a",), "text"),
    Rule("featured", (".img-cont",), ("class",)),
    Rule("featured_src", (".img-cont img",), ("src",)),
    Rule("featured_alt", (".img-cont img",), ("alt",)),
    Rule("caption", (".img-cont .img-cap",), "text"),
    Rule("images", ("#articleBody .imgcontainer img", "#articleBody img"), ("src", "alt", "title")),
)
# Pages of other sites: the first heading and the text of the article element.
GENERIC_CONTAINER = "article"
GENERIC_RULES = (
    Rule("title", ("h1",), "text"),
    Rule("content", ("article",), "deep"),
)

LISTING_LINKS = ("div.bigOneSec h3 a",)
SECTION_LINKS = ("h3 a", ".news-dev8 a")
NAV_LINKS = ("nav li a",)

_TRIPLE = "array<struct<src:string,alt:string,title:string>>"
_ARROW_TRIPLE = pa.list_(pa.struct([(name, pa.string()) for name in ("src", "alt", "title")]))
_ARROW_TEXTS = pa.list_(pa.string())


def pick_nodes(
    pages: DataFrame,
    rules: Sequence[Rule],
    container: str | None = None,
    keep: Sequence[str] = ("url",),
    always: bool = False,
    only: Bloom | None = None,
) -> DataFrame:
    """One row per page with the container: ``keep`` columns and an array per slot.

    ``always`` emits pages without the container as well, with empty arrays. Pages
    whose URL is surely not in ``only`` are skipped before they are parsed.
    """
    slots = {rule.slot: isinstance(rule.pick, tuple) and len(rule.pick) > 1 for rule in rules}
    fields = {f.name: f.dataType.simpleString() for f in pages.schema if f.name in keep}
    out_ddl = ", ".join(
        [f"{name} {kind}" for name, kind in fields.items()]
        + [f"{slot} {_TRIPLE if triple else 'array<string>'}" for slot, triple in slots.items()]
    )
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picker = PagePicker(rules, container)
        for batch in batches:
            if only is not None:
                batch = batch.filter(pa.array(only.may_hold(batch.column("_hash").to_numpy())))
            html = batch.column("_html").to_pylist()
            urls = batch.column("_url").to_pylist()
            picked = [picker.pick(*page) for page in zip(html, urls)]
            if always:
                picked = [nodes or {slot: [] for slot in slots} for nodes in picked]
            rows = pa.array([i for i, nodes in enumerate(picked) if nodes is not None], pa.int64())
            kept = [nodes for nodes in picked if nodes is not None]
            columns = [batch.column(name).take(rows) for name in names]
            for slot, triple in slots.items():
                values = [nodes[slot] for nodes in kept]
                if triple:
                    values = [[dict(zip(("src", "alt", "title"), v)) for v in nodes] for nodes in values]
                columns.append(pa.array(values, _ARROW_TRIPLE if triple else _ARROW_TEXTS))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *slots])

    wanted = pages.select(*names, F.col("url").alias("_url"), F.col("html").alias("_html"), F.xxhash64("url").alias("_hash"))
    return wanted.mapInArrow(run, out_ddl)


def _first(slot: str) -> Column:
    return F.get(slot, F.lit(0))


def _first_text(slot: str) -> Column:
    return ustrip(F.coalesce(_first(slot), F.lit("")))


def _joined(nodes: Column) -> Column:
    """Every node stripped, blanks dropped, joined by one space."""
    return F.array_join(F.filter(F.transform(nodes, ustrip), lambda t: t != ""), " ")


def _media(kind: str, url: Column, alt: Column, caption: Column, site_domain: str) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        url.alias("url"),
        alt.cast("string").alias("alt"),
        caption.cast("string").alias("caption"),
        media_provider(url, site_domain).alias("provider"),
    )


def _media_list(site_domain: str) -> Column:
    """Images, then videos, then audio; the first item per URL stays."""
    null = F.lit(None)
    present = lambda col: F.filter(col, lambda url: url != "")
    caption = _first("caption")
    images = F.transform(
        F.filter("images", lambda img: img["src"] != ""),
        lambda img: _media(
            "image",
            img["src"],
            img["alt"],
            F.coalesce(F.nullif(img["title"], F.lit("")), caption),
            site_domain,
        ),
    )
    videos = F.transform(present("videos"), lambda u: _media("video", u, null, null, site_domain))
    audio = F.transform("audio", lambda u: _media("audio", u, null, null, site_domain))
    return media_first_wins(F.concat(images, videos, audio)).cast(MEDIA_DDL)


def _with_category(pages: DataFrame) -> DataFrame:
    if "category" in pages.columns:
        return pages
    return pages.withColumn("category", F.lit(None).cast("string"))


def extract_articles(
    pages: DataFrame, site_domain: str, keep: Sequence[str] = (), only: Bloom | None = None
) -> DataFrame:
    """Article rows of ``pages(url, html[, category])``; other pages give none."""
    nodes = pick_nodes(
        _with_category(pages), ARCHIVE_RULES, ARCHIVE_CONTAINER, (*keep, "url", "category"), only=only
    )
    return nodes.select(
        *keep,
        _first("article_id").alias("article_id"),
        "url",
        F.coalesce("category", F.lit("unknown")).alias("category"),
        *(_first_text(slot).alias(slot) for slot in ("title", "publish_date", "author")),
        _joined(F.col("content")).alias("content"),
        F.transform("tags", ustrip).alias("tags"),
        _media_list(site_domain).alias("media"),
    )


LEGACY_IMAGES = "array<struct<url:string,alt:string,caption:string,type:string>>"


def _legacy_images() -> Column:
    """The featured image, then body images that are no logo and not seen before."""

    def image(url, alt, caption, kind):
        return F.struct(
            url.alias("url"), alt.alias("alt"), caption.alias("caption"), F.lit(kind).alias("type")
        )

    featured = F.array(
        image(_first("featured_src"), _first("featured_alt"), _first("caption"), "featured")
    )
    wanted = lambda img: (img["src"] != "") & ~F.lower(img["src"]).contains("logo")
    body = F.transform(
        F.filter("images", wanted),
        lambda img: image(img["src"], img["alt"], img["title"], "body_gallery"),
    )
    both = F.concat(F.when(F.size("featured") > 0, featured).otherwise(F.array()), body)
    urls = F.transform(both, lambda img: img["url"])
    unseen = lambda img, i: img["url"].isNull() | (F.array_position(urls, img["url"]) == i + 1)
    return F.filter(both, unseen).cast(LEGACY_IMAGES)


def extract_legacy(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The older record layout: ``images`` instead of ``media``, NULL for missing text.

    Every page gives a row; one without the container becomes a ghost later.
    """
    nodes = pick_nodes(
        _with_category(pages), LEGACY_RULES, ARCHIVE_CONTAINER, (*keep, "url", "category"), always=True
    )
    return nodes.select(
        *keep,
        _first("article_id").alias("article_id"),
        "url",
        "category",
        *(ustrip(_first(slot)).alias(slot) for slot in ("title", "publish_date", "author")),
        ustrip(F.array_join("content", " ")).alias("content"),
        "tags",
        _legacy_images().alias("images"),
    )


def extract_content(
    pages: DataFrame,
    keep: Sequence[str],
    rules: Sequence[Rule] = GENERIC_RULES,
    container: str = GENERIC_CONTAINER,
) -> DataFrame:
    """Title and joined body text of pages, for a layout given by ``rules``."""
    return pick_nodes(pages, rules, container, keep).select(
        *keep, _first_text("title").alias("title"), _joined(F.col("content")).alias("content")
    )


def link_lists(
    pages: DataFrame, selectors: Sequence[str] = LISTING_LINKS, keep: Sequence[str] = ()
) -> DataFrame:
    """``links``: the absolute targets of a listing page, in document order."""
    rule = Rule("links", tuple(selectors), ("href",), resolve=True)
    return pick_nodes(pages, (rule,), None, keep)


def extract_links(
    pages: DataFrame, selectors: Sequence[str] = LISTING_LINKS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per link: ``pos`` in the page and ``link``; repeats are kept."""
    lists = link_lists(pages, selectors, keep)
    return lists.select(*keep, F.posexplode("links").alias("pos", "link"))


def links_per_page(
    pages: DataFrame, selectors: Sequence[str] = LISTING_LINKS, keep: Sequence[str] = ()
) -> DataFrame:
    return link_lists(pages, selectors, keep).select(*keep, F.size("links").alias("n_links"))
