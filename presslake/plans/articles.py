"""Composite jobs over the operators: convert, enrich, crawl, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslake.functions.bloom import bloom_of
from presslake.functions.dates import parse_date
from presslake.functions.text import last_segment
from presslake.operators.analytics import on_month_day
from presslake.operators.coverage import missing_urls
from presslake.operators.dedup import drop_known, first_wins
from presslake.operators.extract import SECTION_LINKS, extract_articles, extract_links
from presslake.operators.links import only_domain, require_category
from presslake.operators.normalize import normalize
from presslake.operators.skew import key_bucket
from presslake.schema import ARTICLE_COLUMNS, CATEGORY_LABELS, ROW_GROUP_ROWS
from presslake.sinks.files import read_partitioned, rewrite_in_place, write_csv, write_lines, write_parquet
from presslake.sources.files import POSITION, scan_lines, scan_url_list, with_source_name


# -- raw lines to articles ---------------------------------------------------
def articles_from_lines(
    lines: DataFrame,
    order: Sequence[str],
    per: Sequence[str] = (),
    dedup: bool = True,
    columns: Sequence[str] = ARTICLE_COLUMNS,
) -> DataFrame:
    """Normalised articles; per input (``per`` columns) the first of each id stays.

    Unwanted ``columns`` are neither read from the JSON nor shuffled.
    """
    needed = [name for name in ARTICLE_COLUMNS if name in columns or name == "article_id"]
    rows = normalize(lines, columns=needed).select(*dict.fromkeys([*per, *order]), *needed)
    if dedup:
        rows = first_wins(rows, [*per, "article_id"], list(order))
    return rows.select(*per, *columns)


def convert(spark: SparkSession, source: str | Sequence[str], target: str, dedup: bool = True) -> None:
    """Raw JSON lines to one Parquet dataset, first-wins within each input file."""
    lines = scan_lines(spark, source)
    rows = articles_from_lines(lines, POSITION, ["src_path"], dedup)
    write_parquet(rows.drop("src_path"), target, row_group_rows=ROW_GROUP_ROWS)


def convert_files(spark: SparkSession, sources: Sequence[str], target: str) -> None:
    """A list of raw files in one job, no de-duplication, one partition per input name."""
    lines = with_source_name(scan_lines(spark, sources))
    rows = normalize(lines).select("src_file", *ARTICLE_COLUMNS)
    write_parquet(rows, target, partition_by=["src_file"], row_group_rows=ROW_GROUP_ROWS)


# -- dates ------------------------------------------------------------------------
def with_dates(articles: DataFrame) -> DataFrame:
    """Add (or recompute) ``date_parsed``."""
    return articles.withColumn("date_parsed", parse_date("publish_date"))


def enrich_in_place(spark: SparkSession, path: str) -> bool:
    """Add ``date_parsed`` to a stored dataset; False if all its rows have been through it.

    A dataset that got new files since is enriched again.
    """
    stored = read_partitioned(spark, path)
    if "date_parsed" in stored.columns:
        dated = stored.select("date_parsed", parse_date("publish_date").alias("expected"))
        if not dated.where("date_parsed is null and expected is not null").limit(1).count():
            return False
    rewrite_in_place(spark, path, with_dates)
    return True


def day_slice_csv(articles: DataFrame, month: int, day: int, target: str) -> None:
    """Distinct (url, content) of one calendar day of every year, as CSV.

    Articles without ``date_parsed`` have their publish date read first.
    """
    dated = articles if "date_parsed" in articles.columns else with_dates(articles)
    write_csv(on_month_day(dated, month, day), target)


# -- layout ----------------------------------------------------------------------
def write_lake(articles: DataFrame, target: str, category: str = "category", ts: str = "date_parsed") -> None:
    """Parquet partitioned by category and publishing day."""
    dated = articles.withColumn("pub_date", F.to_date(ts))
    write_parquet(dated, target, partition_by=[category, "pub_date"])


def archive_pages(pages: DataFrame, target: str) -> None:
    """Raw pages as one Parquet dataset keyed by ``file_id``, the URL's last segment."""
    write_parquet(pages.select(last_segment("url").alias("file_id"), "url", "html"), target)


def land_run(lines: DataFrame, raw_root: str, category: str, run_ts: str) -> str:
    """Append one run's raw lines to ``raw/<category>_<run_ts>.jsonl/``."""
    path = f"{raw_root}/{category}_{run_ts}.jsonl"
    write_lines(lines, path, mode="errorifexists")
    return path


# -- coverage ----------------------------------------------------------------------
def write_missing(spark: SparkSession, url_list: str, scraped: str, target: str) -> None:
    """Original list lines whose URL was not scraped; the output is a valid list again."""
    missing = missing_urls(scan_url_list(spark, url_list), scan_url_list(spark, scraped))
    write_lines(missing.select("value"), target, mode="errorifexists")


# -- crawl -------------------------------------------------------------------------
def follow_links(section_pages: DataFrame, domain: str) -> DataFrame:
    """Distinct on-domain article URLs of the section pages, with their category.

    A URL that several pages list takes the category of the first listing page.
    """
    links = extract_links(section_pages, SECTION_LINKS, ["url", "category"])
    own = only_domain(links.withColumnRenamed("url", "page_url"), domain, "link")
    first = F.min(F.struct("page_url", "pos", "category"))
    per_link = own.groupBy(F.col("link").alias("url"), key_bucket("link").alias("bucket"))
    return per_link.agg(first.alias("f")).select("url", F.col("f.category").alias("category"))


def crawl(section_pages: DataFrame, pages: DataFrame, domain: str) -> DataFrame:
    """Discover, follow, extract: article rows of the pages the sections link to.

    The join with stored pages stands for the download. Pages are parsed where
    they lie, behind a Bloom filter of the links that has the same size for few
    and for many of them; only article rows take part in the join.
    """
    links = follow_links(section_pages, domain)
    rows = extract_articles(pages.select("url", "html"), domain, only=bloom_of(links, "url"))
    label = F.coalesce(F.col("label"), F.lit("unknown"))
    joined = rows.join(links.withColumnRenamed("category", "label"), "url")
    return joined.withColumn("category", label).select(rows.columns)


def category_report(
    articles: DataFrame, requested: Sequence[str], label: str = "category"
) -> DataFrame:
    """Status line per requested category; one without articles is ``FAILED``.

    One job for all categories; a missing one does not stop the others.
    """
    wanted = articles.sparkSession.createDataFrame([(c,) for c in requested], "category string")
    found = (
        articles.filter(F.col(label).isin(*requested))
        .groupBy(F.col(label).alias("category"))
        .agg(F.count("*").alias("n_articles"))
    )
    # ``wanted`` is as long as the argument list, ``found`` at most as long.
    joined = wanted.join(F.broadcast(found), "category", "left")
    n = F.coalesce("n_articles", F.lit(0))
    return joined.select(
        "category", n.alias("n_articles"), F.when(n > 0, "DONE").otherwise("FAILED").alias("status")
    )


def run_categories(articles: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Write the articles of several sections in one job and report on each."""
    labels = [CATEGORY_LABELS[require_category(key)] for key in keys]
    chosen = articles.filter(F.col("category").isin(*labels))
    write_parquet(chosen, target, partition_by=["category"])
    return category_report(articles.sparkSession.read.parquet(target), labels)


# -- runs ------------------------------------------------------------------------
def merge_runs(articles: DataFrame, order: Sequence[str]) -> DataFrame:
    """Overlapping crawl runs to one row per article, the earliest run first."""
    return first_wins(articles, ["article_id"], list(order))


def new_articles(batch: DataFrame, archive: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows a new batch adds to the archive."""
    return drop_known(first_wins(batch, ["article_id"], list(order)), archive)
