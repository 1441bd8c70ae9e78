"""Sections, frontiers and link filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslake.functions.text import in_domain, label_for
from presslake.schema import CATEGORY_LABELS, SECTION_DDL, SECTIONS, SEED_SECTIONS

_CHUNK = 4096


def section_dimension(spark: SparkSession) -> DataFrame:
    """The known sections: key, path prefix, first and last page."""
    return spark.createDataFrame(list(SECTIONS), SECTION_DDL)


def frontier(sections: DataFrame, host: str) -> DataFrame:
    """One URL per section page: ``host + path + page`` for every page lo..hi.

    Pages are laid out in chunks that are spread over the cluster first, so a
    section with a huge page range is no single task's work. The number of tasks
    is given, because by their size alone the chunks would be packed into one.
    """
    n_tasks = int(sections.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = F.explode(F.expr(f"sequence(lo, hi, {_CHUNK})")).alias("start")
    chunks = sections.filter("lo <= hi").select("section", "path", "hi", chunk)
    spread = chunks.repartition(n_tasks, "section", "start")
    last = F.least(F.col("hi"), F.col("start") + (_CHUNK - 1))
    pages = spread.select("section", "path", F.explode(F.sequence("start", last)).alias("page"))
    url = F.concat(F.lit(host), F.col("path"), F.col("page").cast("string"))
    return pages.select("section", "page", url.alias("url"))


def seed_urls(sections: DataFrame, host: str, key: str | None) -> DataFrame:
    """First page of one section that has a seed; no rows for any other key."""
    known = F.col("section").isin(*SEED_SECTIONS) & (F.col("section") == F.lit(key))
    url = F.concat(F.lit(host), F.col("path"), F.lit("1"))
    return sections.filter(known).select("section", url.alias("url"))


def require_category(key: str | None) -> str:
    """The key itself if it names a known category, else ValueError."""
    if not key or key not in CATEGORY_LABELS:
        raise ValueError(f"category key is missing or invalid: {key!r}")
    return key


def with_category(links: DataFrame, key: str) -> DataFrame:
    """Constant category column on the links of one section."""
    return links.withColumn("category", F.lit(key))


def with_label(df: DataFrame, key: str = "category", default: str = "unknown") -> DataFrame:
    """``label``: display name of the category key, ``default`` if unknown."""
    return df.withColumn("label", label_for(F.col(key), CATEGORY_LABELS, default))


def only_domain(df: DataFrame, domain: str, url: str = "url") -> DataFrame:
    """Rows whose URL lies on ``domain`` or a host below it."""
    return df.filter(in_domain(url, domain))
