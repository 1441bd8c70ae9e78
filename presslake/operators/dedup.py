"""First-wins duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from presslake.functions.text import url_key
from presslake.operators.skew import distinct_keys


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep, per key, the row that comes first in ``order``.

    The filter on the first rank lets Spark plan a group limit before the
    shuffle: every map task keeps one row per key, so a key that holds a third of
    all rows reaches its reducer as one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def drop_known(batch: DataFrame, archive: DataFrame, key: str = "article_id") -> DataFrame:
    """Rows of ``batch`` whose key the archive does not hold yet.

    Only the key column of the archive is read, and it is first reduced to the
    keys of the batch. For a batch that is small beside the archive adaptive
    execution broadcasts the batch keys, and the archive is scanned in place
    instead of being shuffled for the anti join.
    """
    known = archive.select(key).join(distinct_keys(batch, key), key, "left_semi")
    return batch.join(distinct_keys(known, key), key, "left_anti")


def media_first_wins(media: Column) -> Column:
    """Drop media items whose URL occurred earlier in the list, whatever their type."""
    urls = F.transform(media, lambda m: m["url"])
    unseen = lambda m, i: m["url"].isNull() | (F.array_position(urls, m["url"]) == i + 1)
    return F.filter(media, unseen)


def frontier_dedup(urls: DataFrame, order: list[str], url: str = "url") -> DataFrame:
    """One row per comparison key: the first spelling and how often it was seen."""
    keyed = urls.withColumn("url_key", url_key(url))
    return keyed.groupBy("url_key").agg(
        F.min_by(F.col(url), F.struct(*order)).alias("url"),
        F.count("*").alias("n_seen"),
    )


def duplicate_stats(deduped: DataFrame) -> DataFrame:
    """Crawl accounting: requests seen, kept, dropped as duplicates."""
    return deduped.agg(
        F.sum("n_seen").alias("n_requests"),
        F.count("*").alias("n_unique"),
        (F.sum("n_seen") - F.count("*")).alias("n_duplicates"),
    )
