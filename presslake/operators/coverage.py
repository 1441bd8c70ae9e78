"""Which discovered URLs have not been scraped yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from presslake.functions.text import url_key
from presslake.operators.skew import distinct_keys


def scraped_keys(scraped: DataFrame, url: str = "url") -> DataFrame:
    """Distinct comparison keys of the non-empty scraped URLs."""
    keyed = scraped.filter(F.col(url) != "").select(url_key(url).alias("url_key"))
    return distinct_keys(keyed, "url_key")


def missing_urls(links: DataFrame, scraped: DataFrame, url: str = "url") -> DataFrame:
    """Rows of ``links`` whose URL is not among the scraped ones.

    Every row of ``links`` counts by itself: repeats and all other columns stay.
    The right side is reduced to distinct keys within each task before it moves;
    adaptive execution splits a left partition that one hot URL makes too large.
    """
    keyed = links.filter(F.col(url) != "").withColumn("url_key", url_key(url))
    return keyed.join(scraped_keys(scraped), "url_key", "left_anti").select(*links.columns)


def coverage_report(links: DataFrame, scraped: DataFrame, url: str = "url") -> DataFrame:
    """One row: unique scraped URLs and missing list rows.

    Both sides are counted per key first, so only (key, counts) is shuffled.
    """
    wanted = links.filter(F.col(url) != "").select(
        url_key(url).alias("url_key"), F.lit(1).alias("n_listed"), F.lit(0).alias("n_scraped")
    )
    have = scraped.filter(F.col(url) != "").select(
        url_key(url).alias("url_key"), F.lit(0).alias("n_listed"), F.lit(1).alias("n_scraped")
    )
    per_key = wanted.unionByName(have).groupBy("url_key").agg(
        F.sum("n_listed").alias("n_listed"), F.max("n_scraped").alias("scraped")
    )
    return per_key.agg(
        F.coalesce(F.sum("scraped"), F.lit(0)).alias("n_scraped"),
        F.coalesce(F.sum(F.col("n_listed") * (1 - F.col("scraped"))), F.lit(0)).alias("n_missing"),
    )


LG_ENTRIES = 16  # a sketch keeps up to 2**16 hashes


def url_sketches(urls: DataFrame, by: str, url: str = "url", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``by, urls``: a theta sketch of the distinct comparison keys of each run, to be stored.

    Sketches of runs merge, intersect and subtract; a run's rows need not be read again.
    """
    keyed = urls.filter(F.col(url) != "").select(by, url_key(url).alias("url_key"))
    return keyed.groupBy(by).agg(F.theta_sketch_agg("url_key", F.lit(lg_entries)).alias("urls"))


def coverage_estimate(listed: DataFrame, scraped: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """One row from stored sketches (column ``urls``): distinct URLs listed, scraped, missing and done.

    ``margin`` bounds the error of each number: four standard errors of a theta sketch
    over the union, ``4 * union / sqrt(2**lg_entries)``, and 0 where the sketches
    hold every URL.
    """
    none = F.lit(None).cast("binary")
    sides = listed.select(F.col("urls").alias("listed"), none.alias("scraped")).unionByName(
        scraped.select(none.alias("listed"), F.col("urls").alias("scraped"))
    )
    both = sides.agg(*(F.theta_union_agg(side, F.lit(lg_entries)).alias(side) for side in ("listed", "scraped")))
    union = F.theta_sketch_estimate(F.theta_union("listed", "scraped", F.lit(lg_entries)))
    entries = float(1 << lg_entries)
    return both.select(
        F.theta_sketch_estimate("listed").alias("n_listed"),
        F.theta_sketch_estimate("scraped").alias("n_scraped"),
        F.theta_sketch_estimate(F.theta_difference("listed", "scraped")).alias("n_missing"),
        F.theta_sketch_estimate(F.theta_intersection("listed", "scraped")).alias("n_done"),
        F.when(union < entries, 0).otherwise(F.ceil(union * (4 / entries**0.5))).cast("long").alias("margin"),
    )
