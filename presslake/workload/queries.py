"""One query per operator of the inventory: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from presslake.functions.dates import before_year, clean_date, parse_clean_date
from presslake.functions.replace import replace_many as replaced
from presslake.functions.text import last_segment, media_provider, url_key, ustrip
from presslake.functions.urls import canonical_url, url_fingerprint as fingerprint_of
from presslake.operators import analytics, coverage, dedup, extract, heavy_hitters, links, profile, search
from presslake.operators.normalize import normalize, reject_report
from presslake.plans import articles as plans, partials
from presslake.plans.clustering import write_clustered
from presslake.plans.enrichment import enrich_increment as enrich_new
from presslake.schema import ARTICLE_COLUMNS, CATEGORY_LABELS, SCALAR_FIELDS
from presslake.session import configure, scratch_dir
from presslake.sinks import files as sinks
from presslake.sources import files as sources, numbered
from presslake.streaming.bucketed import ingest_bucketed as ingest_into, open_archive, read_bucketed
from presslake.streaming.frontier import next_requests, read_requests, start_requests
from presslake.streaming.ingest import ingest, read_archive
from presslake.workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash.

    The session gets its settings here, before the query is built; the operators
    never change them.
    """

    @wraps(fn)
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = configured
    return configured


def _joined(column: str) -> Column:
    return F.array_join(column, "|")


def _landed(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = f"{scratch_dir(spark, name)}.jsonl"
    sinks.write_lines(lines.select("value"), path)
    return path


def _exploded_media(rows: DataFrame, *keep: str) -> DataFrame:
    items = rows.select(*keep, F.posexplode("media").alias("pos", "m"))
    return items.select(*keep, F.col("pos").cast("long").alias("pos"), "m.*")


# -- sources ------------------------------------------------------------------
@query
def scan_jsonl(spark, sf_dir):
    path = _landed(spark, fx.article_lines(spark, sf_dir), "scan-jsonl")
    fields = "article_id: string, url: string, category: string, content: string"
    rows = sources.scan_jsonl(spark, path, fields)
    return rows.drop(*sources.POSITION)


@query
def scan_url_list(spark, sf_dir):
    lines = fx.url_list_lines(spark, sf_dir)
    broken = F.explode(F.array("value", F.lit(" "), F.lit('{"url": ""}'), F.lit('{"url": "x')))
    path = _landed(spark, lines.select(broken.alias("value")), "url-list")
    text = f"{scratch_dir(spark, 'url-text')}.txt"
    plain = sources.urls_of_lines(lines).select(F.concat(F.lit("  "), "url", F.lit("\t")).alias("value"))
    sinks.write_lines(plain, text)
    from_json = sources.scan_url_list(spark, path).select(F.lit("jsonl").alias("kind"), "url")
    return from_json.unionByName(sources.scan_url_text(spark, text).select(F.lit("txt").alias("kind"), "url"))


@query
def scan_limit(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").orderBy("doc_id")
    value = F.when(F.col("doc_id") % 53 == 0, "").otherwise(F.concat(F.lit("line "), "doc_id"))
    path = _landed(spark, docs.select(value.alias("value")), "scan-limit")
    return sources.scan_limit(spark, path, 150).select("value")


@query
def line_numbers(spark, sf_dir):
    """Lines 5 to 104 of every file of a feed that is split into small blocks."""
    path = _landed(spark, fx.numbered_lines(spark, sf_dir), "line-numbers")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        kept = scratch_dir(spark, "line-slice")
        sinks.write_parquet(numbered.line_slice(spark, path, 5, 105), kept)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    # Every line says where it stands: file, number and document.
    rows = spark.read.parquet(kept).selectExpr("line_no", "from_json(value, 'part int, n long, doc_id long') as r")
    return rows.select("line_no", F.col("r.part").cast("long").alias("part"), "r.n", "r.doc_id")


@query
def shape(spark, sf_dir):
    counts = analytics.shape(fx.table(spark, sf_dir, "documents"))
    return spark.createDataFrame([counts], "n_rows long, n_columns long")


@query
def seed(spark, sf_dir):
    """The seed page of one section; the sections are the sources, one of them under a known key."""
    named = F.when(F.col("section") == "src0", "urgent").otherwise(F.col("section"))
    sections = fx.source_sections(spark, sf_dir).withColumn("section", named)
    return links.seed_urls(sections, fx.HOST, "urgent")


@query
def frontier(spark, sf_dir):
    return links.frontier(fx.source_sections(spark, sf_dir), fx.HOST)


@query
def batch_by_file(spark, sf_dir):
    lines = fx.article_lines(spark, sf_dir)
    category = F.coalesce(F.get_json_object("value", "$.category"), F.lit("none"))
    raw = scratch_dir(spark, "batch-raw")
    named = lines.select("value", F.concat(category, F.lit(".jsonl")).alias("src_file"))
    named.hint("rebalance", "src_file").write.partitionBy("src_file").text(raw)
    out = scratch_dir(spark, "batch-out")
    plans.convert_files(spark, [f"{raw}/src_file=*"], out)
    stored = spark.read.parquet(out)
    return stored.select("src_file", "article_id", "title", "content")


# -- record normalisation ---------------------------------------------------------
@query
def normalize_(spark, sf_dir):
    rows = normalize(fx.article_lines(spark, sf_dir))
    return rows.select(
        "seq",
        *SCALAR_FIELDS,
        F.size("tags").cast("long").alias("n_tags"),
        F.size("media").cast("long").alias("n_media"),
    )


@query
def normalize_scalars(spark, sf_dir):
    return normalize(fx.article_lines(spark, sf_dir)).select("seq", "title", "author", "publish_date")


@query
def normalize_tags(spark, sf_dir):
    return normalize(fx.article_lines(spark, sf_dir)).select("seq", _joined("tags").alias("tags"))


@query
def normalize_media(spark, sf_dir):
    return _exploded_media(normalize(fx.article_lines(spark, sf_dir)), "seq")


@query
def ghost_filter(spark, sf_dir):
    return normalize(fx.article_lines(spark, sf_dir)).select("article_id", "url")


@query
def dedup_first(spark, sf_dir):
    rows = normalize(fx.article_lines(spark, sf_dir)).select("seq", "article_id", "title", "content")
    return dedup.first_wins(rows, ["article_id"], ["seq"])


@query
def dedup_cross_run(spark, sf_dir):
    runs = fx.crawl_runs(spark, sf_dir).select("run_ts", "line_no", "article_id", "title", "content")
    return plans.merge_runs(runs, ["run_ts", "line_no"])


@query
def append_new(spark, sf_dir):
    runs = fx.crawl_runs(spark, sf_dir).select("run_ts", "line_no", "article_id", "title")
    archive = runs.filter("run_ts = '20240101T000000'")
    batch = runs.filter("run_ts = '20240102T000000'")
    return plans.new_articles(batch, archive, ["line_no"])


@query
def reject_report_(spark, sf_dir):
    lines = fx.article_lines(spark, sf_dir).select("value", F.lit("feed").alias("src"))
    return reject_report(lines, ["src"])


@query
def articles_table(spark, sf_dir):
    rows = plans.articles_from_lines(fx.article_lines(spark, sf_dir), ["seq"])
    return plans.with_dates(rows).select(
        "article_id",
        "url",
        "category",
        "title",
        "author",
        "content",
        "date_parsed",
        _joined("tags").alias("tags"),
        F.size("media").cast("long").alias("n_media"),
    )


@query
def top_tags_feed(spark, sf_dir):
    """The flagship: raw feed to top tags; only id, URL and tags are read from the JSON."""
    lines = fx.article_lines(spark, sf_dir)
    return analytics.top_tags(plans.articles_from_lines(lines, ["seq"], columns=["article_id", "tags"]))


# -- scalar functions -----------------------------------------------------------
@query
def ustrip_(spark, sf_dir):
    padded = F.concat(F.lit("  　"), "text", F.lit(" \t\x1f"))
    return fx.table(spark, sf_dir, "documents").select("doc_id", ustrip(padded).alias("stripped"))


@query
def url_key_(spark, sf_dir):
    return fx.encoded_urls(spark, sf_dir).select("doc_id", url_key("url").alias("url_key"))


@query
def date_clean(spark, sf_dir):
    return fx.dated_events(spark, sf_dir).select("event_id", clean_date("publish_date").alias("clean"))


@query
def parse_date(spark, sf_dir):
    clean = fx.dated_events(spark, sf_dir).select("event_id", clean_date("publish_date").alias("clean"))
    return clean.select("event_id", parse_clean_date(F.col("clean")).alias("date_parsed"))


@query
def replace_many(spark, sf_dir):
    """Keys that contain each other, and one whose replacement is another key."""
    docs = fx.dealt(fx.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    keys = {"a": "b", "b": "c", "an": "<AN>", "and ": "& ", "er": "", "e": "a", ".": "(.)"}
    return docs.select("doc_id", replaced("text", keys).alias("text"))


@query
def page_id(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", last_segment("url").alias("file_id"))


@query
def media_provider_(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url")
    other = F.concat(F.lit("https://cdn.other.org/"), "page_id", F.lit(".jpg"))
    static = F.concat(F.lit("https://cdn.other.org/static/"), "page_id", F.lit(".jpg"))
    urls = pages.select("page_id", F.posexplode(F.array("url", other, static, F.lit(""))).alias("pos", "u"))
    return urls.select(
        "page_id", F.col("pos").cast("long").alias("pos"), media_provider(F.col("u"), fx.SITE).alias("provider")
    )


@query
def category_label(spark, sf_dir):
    keys = F.array(*(F.lit(key) for key in (*CATEGORY_LABELS, "politics", "reports")))
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    keyed = docs.withColumn("category", F.get(keys, (F.col("doc_id") % 10).cast("int")))
    return links.with_label(keyed)


# -- analytics --------------------------------------------------------------------
@query
def top_tags(spark, sf_dir):
    return analytics.top_tags(fx.articles(spark, sf_dir))


@query
def top_tags_sketch(spark, sf_dir):
    """Summaries of 64 tags a task for a thousand tags: the rare ones are never counted."""
    return heavy_hitters.top_tags_sketch(fx.articles(spark, sf_dir), capacity=64)


def _batches(spark, sf_dir):
    """Articles in three batches, the second of which runs twice."""
    rows = fx.articles(spark, sf_dir).withColumn("batch", F.col("article_id").cast("long") % 3)
    return [(n, rows.where(F.col("batch") == n)) for n in (0, 1, 1, 2)]


@query
def heatmap_incremental(spark, sf_dir):
    path = scratch_dir(spark, "heatmap-parts")
    for n, batch in _batches(spark, sf_dir):
        partials.put_heatmap(batch, path, n)
    partials.fold_parts(spark, path, partials.HEATMAP_DDL)
    rows = partials.merged_heatmap(spark, path)
    return rows.select(*(F.col(c).cast("long").alias(c) for c in rows.columns))


@query
def top_tags_incremental(spark, sf_dir):
    path = scratch_dir(spark, "tag-parts")
    for n, batch in _batches(spark, sf_dir):
        partials.put_tag_counts(batch, path, n)
    return partials.merged_top_tags(spark, path, analytics.TOP_TAGS)


@query
def top_tags_share(spark, sf_dir):
    return analytics.top_tags_share(fx.articles(spark, sf_dir))


@query
def tag_lookup(spark, sf_dir):
    return analytics.tag_counts(fx.articles(spark, sf_dir)).filter("tag = 'news'")


@query
def heatmap(spark, sf_dir):
    rows = analytics.heatmap(fx.articles(spark, sf_dir))
    return rows.select(*(F.col(c).cast("long").alias(c) for c in rows.columns))


@query
def heatmap_pivot(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(F.col("ts").alias("date_parsed"))
    return analytics.heatmap_pivot(events).withColumn("weekday", F.col("weekday").cast("long"))


@query
def sql_month_day(spark, sf_dir):
    return analytics.on_month_day(fx.orders_as_articles(spark, sf_dir), 3, 21)


@query
def sql_like(spark, sf_dir):
    return analytics.content_like(fx.articles(spark, sf_dir), "tion the")


@query
def content_search(spark, sf_dir):
    """The same as ``sql_like``, by an index that says which files to open."""
    path = scratch_dir(spark, "searched")
    sinks.write_parquet(fx.dealt(fx.articles(spark, sf_dir).select("article_id", "content"), "article_id"), f"{path}/articles")
    search.write_content_index(spark, f"{path}/articles", f"{path}/index")
    return search.content_search(spark, f"{path}/articles", spark.read.parquet(f"{path}/index"), "tion the").select("content")


@query
def before_year_(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return orders.filter(before_year(F.col("o_orderdate"), 1996))


@query
def head_n(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return analytics.head(orders.filter(before_year(F.col("o_orderdate"), 1996)), 10, ["o_orderkey"])


@query
def quality_filters(spark, sf_dir):
    return analytics.quality_issues(fx.articles(spark, sf_dir))


@query
def column_counts(spark, sf_dir):
    return analytics.column_counts(fx.articles(spark, sf_dir))


@query
def column_counts_batches(spark, sf_dir):
    """Counts per source, consumed in lists of three rows and put together again."""
    counts = fx.articles(spark, sf_dir).groupBy("category").agg(F.count("title").alias("n_titles"))
    rows = [tuple(row) for batch in analytics.in_batches(counts, 3) for row in batch]
    return spark.createDataFrame(rows, counts.schema)


@query
def n_unique_rows(spark, sf_dir):
    return analytics.n_unique_rows(fx.table(spark, sf_dir, "documents").select("text", "lang"))


@query
def n_unique_events(spark, sf_dir):
    """Times to the microsecond and doubles, with both zeros."""
    events = fx.table(spark, sf_dir, "events")
    zero = F.when(F.col("event_id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))
    return analytics.n_unique_rows(events.select("ts", "event_type", "value", (zero * F.col("user_id")).alias("zero")))


@query
def distinct_content(spark, sf_dir):
    return analytics.distinct_values(fx.articles(spark, sf_dir), "content")


@query
def describe(spark, sf_dir):
    return analytics.describe(
        fx.articles(spark, sf_dir).select("title", "author", "tags", "date_parsed", "n_chars")
    )


@query
def describe_merged(spark, sf_dir):
    """The profile of two stored batches of parts, merged, and one refining pass."""
    path = scratch_dir(spark, "profiles")
    rows = fx.articles(spark, sf_dir)
    columns = ["title", "author", "tags", "date_parsed", "n_chars"]
    for batch in (F.col("n_chars") < 1000, F.col("n_chars") >= 1000):
        sinks.write_parquet(profile.profile_parts(rows.where(batch).select("category", *columns), ["category"]), path, mode="append")
    return profile.describe_merged(rows.select(*columns), spark.read.parquet(path))


# -- coverage and frontier ---------------------------------------------------------
@query
def missing_urls(spark, sf_dir):
    wanted = sources.urls_of_lines(fx.url_list_lines(spark, sf_dir))
    have = sources.urls_of_lines(fx.scraped_lines(spark, sf_dir))
    return coverage.missing_urls(wanted, have).select("value")


@query
def missing_urls_txt(spark, sf_dir):
    wanted = sources.urls_of_lines(fx.url_list_lines(spark, sf_dir)).select(ustrip("url").alias("url"))
    have = sources.urls_of_lines(fx.scraped_lines(spark, sf_dir))
    return coverage.missing_urls(wanted, have)


@query
def coverage_report(spark, sf_dir):
    wanted = sources.urls_of_lines(fx.url_list_lines(spark, sf_dir))
    have = sources.urls_of_lines(fx.scraped_lines(spark, sf_dir))
    return coverage.coverage_report(wanted, have)


@query
def coverage_estimate(spark, sf_dir):
    """Coverage from the stored sketches of runs, and whether the exact numbers lie within its margin."""
    path = scratch_dir(spark, "sketches")
    sides = {}
    for name, lines in (("listed", fx.url_list_lines), ("scraped", fx.scraped_lines)):
        urls = sources.urls_of_lines(lines(spark, sf_dir))
        runs = urls.withColumn("run", F.pmod(F.xxhash64("value"), F.lit(3)))
        sinks.write_parquet(coverage.url_sketches(runs, "run"), f"{path}/{name}")
        sides[name] = urls.where("url <> ''").select(url_key("url").alias("k")).distinct()
    stored = [spark.read.parquet(f"{path}/{name}") for name in sides]
    exact = sides["listed"].withColumn("listed", F.lit(1)).join(sides["scraped"].withColumn("scraped", F.lit(1)), "k", "full")
    exact = exact.agg(
        F.count("listed").alias("listed"),
        F.count("scraped").alias("scraped"),
        F.count_if(F.col("scraped").isNull()).alias("missing"),
        F.count_if(F.col("listed").isNotNull() & F.col("scraped").isNotNull()).alias("done"),
    )
    found = coverage.coverage_estimate(*stored)
    columns = []
    for name, number in exact.first().asDict().items():
        columns += [F.lit(number).alias(name), (F.abs(F.col(f"n_{name}") - number) <= F.col("margin")).alias(f"{name}_within_margin")]
    return found.select(*columns)


def _nav_links(spark, sf_dir):
    return extract.extract_links(fx.table(spark, sf_dir, "pages"), extract.NAV_LINKS, ["page_id"])


@query
def frontier_dedup(spark, sf_dir):
    return dedup.frontier_dedup(_nav_links(spark, sf_dir), ["page_id", "pos"], "link")


@query
def frontier_duplicates(spark, sf_dir):
    return dedup.duplicate_stats(frontier_dedup(spark, sf_dir))


@query
def listing_links(spark, sf_dir):
    rows = extract.extract_links(fx.listing_pages(spark, sf_dir), keep=["url"])
    return rows.withColumn("pos", F.col("pos").cast("long"))


@query
def link_category(spark, sf_dir):
    rows = extract.extract_links(fx.listing_pages(spark, sf_dir), extract.SECTION_LINKS)
    return links.with_category(rows.select("link"), "economy")


@query
def domain_filter(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url")
    return links.only_domain(pages, fx.SITE)


# -- extraction ---------------------------------------------------------------------
@query
def extract_links(spark, sf_dir):
    return _nav_links(spark, sf_dir).withColumn("pos", F.col("pos").cast("long"))


@query
def links_per_page(spark, sf_dir):
    counts = extract.links_per_page(fx.table(spark, sf_dir, "pages"), extract.NAV_LINKS, ["page_id"])
    return counts.select("page_id", F.col("n_links").cast("long").alias("n_links"))


@query
def extract_articles(spark, sf_dir):
    rows = extract.extract_articles(fx.article_pages(spark, sf_dir), fx.SITE)
    return rows.withColumn("tags", _joined("tags")).withColumn("media", F.size("media").cast("long"))


@query
def extract_content(spark, sf_dir):
    return extract.extract_content(fx.table(spark, sf_dir, "pages"), ["page_id"])


@query
def extract_media(spark, sf_dir):
    rows = extract.extract_articles(fx.article_pages(spark, sf_dir), fx.SITE)
    return _exploded_media(rows, "article_id")


@query
def extract_legacy(spark, sf_dir):
    rows = extract.extract_legacy(fx.article_pages(spark, sf_dir), ["doc_id"])
    images = F.transform("images", lambda i: F.concat_ws(",", i["type"], i["url"], i["alt"], i["caption"]))
    return rows.withColumn("tags", _joined("tags")).withColumn("images", F.array_join(images, "|"))


@query
def media_dedup(spark, sf_dir):
    rows = fx.repeated_media(spark, sf_dir)
    return _exploded_media(rows.withColumn("media", dedup.media_first_wins(F.col("media"))), "doc_id")


def _crawled(spark, sf_dir, sections):
    pages = fx.article_pages(spark, sf_dir).drop("category")
    rows = plans.crawl(sections, pages, fx.SITE)
    return rows.select("article_id", "url", "category", "title", "content")


@query
def crawl_join_extract(spark, sf_dir):
    """A run over the sections of one category."""
    sections = fx.listing_pages(spark, sf_dir)
    return _crawled(spark, sf_dir, sections.where("category = 'section0'"))


@query
def crawl_backfill(spark, sf_dir):
    """A run that follows every link."""
    return _crawled(spark, sf_dir, fx.listing_pages(spark, sf_dir))


# -- sinks and layout ------------------------------------------------------------------
@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "roundtrip")
    sinks.write_parquet(normalize(fx.article_lines(spark, sf_dir)).select(*ARTICLE_COLUMNS), path)
    stored = spark.read.parquet(path)
    return stored.select(
        *SCALAR_FIELDS, _joined("tags").alias("tags"), F.to_json("media").alias("media")
    ).withColumn("media", F.length("media") > 2)


@query
def csv_export(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    sinks.write_csv(fx.articles(spark, sf_dir).select("url", "content"), path)
    return sinks.read_csv(spark, path, "url string, content string")


@query
def enrich_in_place(spark, sf_dir):
    path = scratch_dir(spark, "enrich")
    sinks.write_parquet(fx.dated_events(spark, sf_dir), path)
    plans.enrich_in_place(spark, path)
    plans.enrich_in_place(spark, path)  # a second run finds nothing to do
    return spark.read.parquet(path).select("event_id", "date_parsed")


@query
def enrich_increment(spark, sf_dir):
    """Two batches of events, enriched as they arrive; each batch brings partitions of its own."""
    path = scratch_dir(spark, "enrich-increment")
    events = fx.dated_events(spark, sf_dir)
    month = F.regexp_extract("publish_date", r"^(?:[^،]*، )?\d+ (\S+)", 1)
    rows = events.withColumn("month", month).withColumn("run", (F.col("event_id") % 3).cast("string"))
    for run in ("0", "1", "2"):
        sinks.write_parquet(rows.where(F.col("run") == run), path, mode="append", partition_by=["run", "month"])
        enrich_new(spark, path)
    enrich_new(spark, path)  # nothing new has arrived
    return sinks.read_partitioned(spark, path).select("event_id", "date_parsed", "month")


@query
def partitioned_layout(spark, sf_dir):
    path = scratch_dir(spark, "lake")
    events = fx.table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type as category", "ts as date_parsed"
    )
    plans.write_lake(events, path)
    ddl = "event_id long, date_parsed timestamp_ntz, category string, pub_date date"
    return spark.read.schema(ddl).parquet(path).withColumn("pub_date", F.col("pub_date").cast("string"))


@query
def clustered_layout(spark, sf_dir):
    """Articles clustered by time, category and id; one category of one year is read back."""
    path = scratch_dir(spark, "clustered")
    write_clustered(fx.articles(spark, sf_dir), path, n_files=8, row_group_rows=200)
    year = "date_parsed >= timestamp_ntz'2014-01-01 00:00:00' and date_parsed < timestamp_ntz'2015-01-01 00:00:00'"
    return spark.read.parquet(path).where(f"category in ('src0', 'src1') and {year}").select("article_id", "category", "date_parsed")


@query
def category_batch(spark, sf_dir):
    requested = [f"src{i}" for i in range(20)] + ["nowhere"]
    return plans.category_report(fx.articles(spark, sf_dir), requested)


def _runs(spark, sf_dir):
    """Two overlapping crawl runs of the feed."""
    lines = fx.article_lines(spark, sf_dir)
    return [
        ("20240101T000000", lines.filter(F.col("n_chars") < fx.FIRST_RUN_BELOW).select("value")),
        ("20240102T000000", lines.filter(F.col("n_chars") >= fx.SECOND_RUN_FROM).select("value")),
    ]


@query
def ingest_incremental(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    raw, target, checkpoint = f"{root}/raw", f"{root}/articles", f"{root}/checkpoint"
    for run_ts, lines in _runs(spark, sf_dir):
        plans.land_run(lines, raw, "urgent", run_ts)
        ingest(spark, raw, target, checkpoint)
    ingest(spark, raw, target, checkpoint)  # nothing new has arrived
    return read_archive(spark, target).select("article_id", "title", "content", "batch")


@query
def ingest_enriched(spark, sf_dir):
    """Ingest, enrich, ingest: the archive keeps its batches, its first lines and its dates."""
    root = scratch_dir(spark, "ingest-enriched")
    raw, target, checkpoint = f"{root}/raw", f"{root}/articles", f"{root}/checkpoint"
    for run_ts, lines in _runs(spark, sf_dir):
        plans.land_run(lines, raw, "urgent", run_ts)
        ingest(spark, raw, target, checkpoint)
        plans.enrich_in_place(spark, target)
    return read_archive(spark, target).select("article_id", "title", "date_parsed", "batch")


# A waiting run is one file as long as it is small, and no task writes more than this of its documents.
BACKLOG_FILES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "384m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


@query
def ingest_backlog(spark, sf_dir):
    """Two waiting runs with the same ids, worked off file by file: the run that landed first wins."""
    root = scratch_dir(spark, "ingest-backlog")
    raw, target, checkpoint = f"{root}/raw", f"{root}/articles", f"{root}/checkpoint"
    lines = fx.article_lines(spark, sf_dir, fx.filed).select("value")
    retitled = lines.withColumn("value", F.replace("value", F.lit('"title":"'), F.lit('"title":"later ')))
    before = {name: spark.conf.get(name) for name in BACKLOG_FILES}
    for name, value in BACKLOG_FILES.items():
        spark.conf.set(name, value)
    try:
        plans.land_run(lines, raw, "urgent", "20240101T000000")
        plans.land_run(retitled, raw, "arab", "20240102T000000")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    ingest(spark, raw, target, checkpoint, max_files_per_batch=1)
    return read_archive(spark, target).select("article_id", "title")


@query
def ingest_resume(spark, sf_dir):
    """The second run ends after its batch was written and before it was noted: it runs again."""
    root = scratch_dir(spark, "ingest-resume")
    raw, target, checkpoint = f"{root}/raw", f"{root}/articles", f"{root}/checkpoint"
    for run_ts, lines in _runs(spark, sf_dir):
        plans.land_run(lines, raw, "urgent", run_ts)
        ingest(spark, raw, target, checkpoint)
    hadoop = spark._jvm.org.apache.hadoop.fs
    note = hadoop.Path(f"{checkpoint}/commits/1")
    note.getFileSystem(spark._jsc.hadoopConfiguration()).delete(note, False)
    ingest(spark, raw, target, checkpoint)
    return read_archive(spark, target).select("article_id", "title", "content", "batch")


@query
def ingest_bucketed(spark, sf_dir):
    """Runs into an archive laid out by id; each batch reads the shelves of its ids."""
    root = scratch_dir(spark, "ingest-bucketed")
    raw, checkpoint = f"{root}/raw", f"{root}/checkpoint"
    archive = open_archive(spark, f"{root}/articles")
    for run_ts, lines in _runs(spark, sf_dir):
        plans.land_run(lines, raw, "urgent", run_ts)
        ingest_into(spark, raw, archive, checkpoint)
    ingest_into(spark, raw, archive, checkpoint)  # nothing new has arrived
    return read_bucketed(spark, archive).select("article_id", "title", "date_parsed", "batch")


@query
def convert_runs(spark, sf_dir):
    root = scratch_dir(spark, "convert")
    runs = _runs(spark, sf_dir)
    files = [plans.land_run(lines, f"{root}/raw", "urgent", run_ts) for run_ts, lines in runs]
    plans.convert(spark, files, f"{root}/articles")
    return spark.read.parquet(f"{root}/articles").select("article_id", "title", "content")


@query
def feed_jsonl(spark, sf_dir):
    path = scratch_dir(spark, "feed")
    rows = extract.extract_articles(fx.article_pages(spark, sf_dir), fx.SITE)
    run = rows.withColumn("run_ts", F.lit("20240101T000000"))
    sinks.write_jsonl(run, path, partition_by=["category", "run_ts"])
    ddl = "article_id string, url string, title string, tags array<string>, category string, run_ts string"
    return spark.read.schema(ddl).json(path).withColumn("tags", _joined("tags"))


@query
def link_list(spark, sf_dir):
    path = f"{scratch_dir(spark, 'links')}.txt"
    sinks.write_lines(_nav_links(spark, sf_dir).select("link"), path)
    sinks.write_lines(fx.table(spark, sf_dir, "pages").select("url"), path)  # appends
    return sources.scan_url_text(spark, path)


@query
def day_slice_csv(spark, sf_dir):
    path = scratch_dir(spark, "slice")
    plans.day_slice_csv(fx.orders_as_articles(spark, sf_dir), 3, 21, path)
    return sinks.read_csv(spark, path, "url string, content string")


@query
def day_slice_events(spark, sf_dir):
    """From the Arabic publish date to the CSV of one calendar day."""
    path = scratch_dir(spark, "slice-events")
    plans.day_slice_csv(fx.dated_events(spark, sf_dir), 3, 21, path)
    return sinks.read_csv(spark, path, "url string, content string")


@query
def missing_file(spark, sf_dir):
    root = scratch_dir(spark, "missing")
    wanted, have, out = f"{root}/wanted.jsonl", f"{root}/have.jsonl", f"{root}/missing.jsonl"
    sinks.write_lines(fx.url_list_lines(spark, sf_dir), wanted)
    sinks.write_lines(fx.scraped_lines(spark, sf_dir), have)
    plans.write_missing(spark, wanted, have, out)
    return sources.scan_url_list(spark, out).select("value")


@query
def missing_input(spark, sf_dir):
    """Inputs that are not there count as empty: every listed URL is missing."""
    root = scratch_dir(spark, "missing-input")
    wanted, out = f"{root}/wanted.jsonl", f"{root}/missing.jsonl"
    sinks.write_lines(fx.url_list_lines(spark, sf_dir), wanted)
    plans.write_missing(spark, wanted, f"{root}/nowhere.jsonl", out)
    absent = sources.scan_url_text(spark, f"{root}/nowhere.txt").select(F.col("url").alias("value"))
    return sources.scan_url_list(spark, [out, f"{root}/nowhere.jsonl"]).select("value").unionByName(absent)


@query
def category_run(spark, sf_dir):
    keys = list(CATEGORY_LABELS)
    labels = F.array(*(F.lit(CATEGORY_LABELS[key]) for key in keys[:-1]))
    rows = fx.articles(spark, sf_dir)
    number = (F.col("article_id").cast("long") % (len(keys) - 1)).cast("int")
    labelled = rows.withColumn("category", F.get(labels, number))
    return plans.run_categories(labelled, keys, scratch_dir(spark, "categories"))


@query
def page_archive(spark, sf_dir):
    path = scratch_dir(spark, "pages")
    plans.archive_pages(fx.table(spark, sf_dir, "pages"), path)
    return spark.read.parquet(path)


# -- addresses and requests ---------------------------------------------------------------
@query
def url_fingerprint(spark, sf_dir):
    """Spellings per address, by fingerprint."""
    rows = fx.spelled_urls(spark, sf_dir)
    keyed = rows.select("doc_id", canonical_url("url").alias("url"), fingerprint_of("url").alias("fingerprint"))
    per_address = keyed.groupBy("fingerprint").agg(
        F.min("doc_id").alias("doc_id"), F.min("url").alias("url"), F.count("*").alias("n_spellings")
    )
    return per_address.withColumn("fingerprint", F.lower(F.hex("fingerprint")))


@query
def frontier_resume(spark, sf_dir):
    """Three runs over other spellings of the same links; the second is stopped while it works."""
    root = scratch_dir(spark, "frontier-resume")
    found, target, checkpoint = f"{root}/found", f"{root}/requests", f"{root}/checkpoint"
    lines = fx.found_links(spark, sf_dir)
    for run in (1, 2, 3):
        sinks.write_lines(lines.where(F.col("run") == run).select("value"), f"{found}/run_{run}.jsonl")
        if run == 2:
            start_requests(spark, found, target, checkpoint).stop()
        else:
            next_requests(spark, found, target, checkpoint)
    return read_requests(spark, target).select("url")
