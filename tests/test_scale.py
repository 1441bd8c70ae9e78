"""What the plans must look like for large inputs, and properties over the workload."""

import glob
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.functions.bloom import bloom_of
from presslake.operators.coverage import coverage_report, missing_urls
from presslake.operators.dedup import first_wins
from presslake.operators.extract import extract_articles
from presslake.operators.normalize import normalize
from presslake.plans import articles as plans
from presslake.sinks.files import _balanced
from presslake.sources.files import urls_of_lines
from presslake.streaming.ingest import ingest, read_archive
from presslake.workload import fixtures as fx
from presslake.workload.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

# The only windows: the first row per key, limited before the shuffle, and the
# share within the top-k report.
FIRST_ROWS = {"dedup_first", "dedup_cross_run", "append_new", "articles_table", "top_tags_feed"}
WINDOWS = {"top_tags_share", *FIRST_ROWS}
# One-row results.
TOTALS = {"column_counts", "n_unique_rows", "n_unique_events", "coverage_report", "coverage_estimate", "frontier_duplicates"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    assert ("Window " in plan) == (name in WINDOWS)
    assert ("row_number(), 1, Partial" in plan) == (name in FIRST_ROWS)
    assert ("SinglePartition" in plan) == (name in TOTALS)


def test_page_bodies_do_not_pass_the_python_stage(spark):
    plan = physical(extract_articles(fx.article_pages(spark, SF_DIR), fx.SITE))
    above = plan[: plan.index("MapInArrow")]
    assert "html" not in above and "Exchange" not in above


def test_feed_reads_only_the_named_fields(spark):
    plan = physical(QUERIES["top_tags_feed"](spark, SF_DIR))
    start = plan.index("from_json(")
    parsed = plan[start : plan.index("StructField(_bad", start)]
    assert "StructField(tags" in parsed and "StructField(content" not in parsed


def test_crawl_never_moves_html(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = fx.table(spark, SF_DIR, "pages").select("url", "html")
        plan = physical(plans.crawl(fx.listing_pages(spark, SF_DIR), pages, fx.SITE))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    side = plan[plan.index("SortMergeJoin") :]
    for part in side.split("Exchange ")[1:]:
        rows = part.split("MapInArrow")[0]
        assert "html" not in rows.replace("_html", "html") or "MapInArrow" not in part


def test_bloom_filter_holds_every_value(spark):
    links = spark.range(5000).select(F.concat(F.lit("http://x/"), "id").alias("url"))
    bloom = bloom_of(links, "url")
    hashes = [r[0] for r in spark.range(10000).select(F.xxhash64(F.concat(F.lit("http://x/"), "id"))).collect()]
    held = bloom.may_hold(np.array(hashes, np.int64))
    assert held[:5000].all() and held[5000:].mean() < 0.01
    assert not bloom_of(links.limit(0), "url").may_hold(np.array(hashes, np.int64)).any()


def test_partitioned_writes_are_rebalanced(spark):
    df = spark.range(10).withColumn("category", F.col("id") % 3)
    assert "REBALANCE_PARTITIONS_BY_COL" in physical(_balanced(df, ["category"]))
    assert _balanced(df, []) is df


def test_dedup_output_is_unique_and_part_of_the_input(spark):
    rows = normalize(fx.article_lines(spark, SF_DIR)).select("seq", "article_id", "title")
    kept = first_wins(rows, ["article_id"], ["seq"])
    assert kept.count() == kept.select("article_id").distinct().count()
    assert kept.exceptAll(rows).count() == 0
    assert kept.count() == rows.select("article_id").distinct().count()


def test_missing_and_matched_add_up(spark):
    wanted = urls_of_lines(fx.url_list_lines(spark, SF_DIR))
    have = urls_of_lines(fx.scraped_lines(spark, SF_DIR))
    missing = missing_urls(wanted, have)
    matched = wanted.count() - missing.count()
    assert missing.count() == coverage_report(wanted, have).first().n_missing
    assert matched + missing.count() == wanted.count() and matched > 0


def test_incremental_equals_batch(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    lines = fx.article_lines(spark, SF_DIR).select("value")
    path = plans.land_run(lines, raw, "urgent", "1")
    ingest(spark, raw, f"{tmp_path}/stream", f"{tmp_path}/check")
    batch = plans.articles_from_lines(spark.read.text(path).withColumn("n", F.monotonically_increasing_id()), ["n"])
    ids = batch.select("article_id")
    streamed = read_archive(spark, f"{tmp_path}/stream").select("article_id")
    assert ids.exceptAll(streamed).count() == 0 and streamed.exceptAll(ids).count() == 0


def test_lake_prunes_partitions(spark, tmp_path):
    path = f"{tmp_path}/lake"
    events = fx.table(spark, SF_DIR, "events").selectExpr("event_id", "event_type as category", "ts as date_parsed")
    plans.write_lake(events, path)
    stored = spark.read.parquet(path)
    category, pub_date = stored.select("category", F.col("pub_date").cast("string")).first()
    day = spark.read.schema(stored.schema).parquet(path).filter(
        f"category = '{category}' and pub_date = date'{pub_date}'"
    )
    expected = day.count()
    kept = f"category={category}/pub_date={pub_date}"
    spoilt = 0
    for file in glob.glob(f"{path}/*/*/*.parquet"):
        if kept not in file:
            with open(file, "wb") as broken:
                broken.write(b"no parquet")
            crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
            if os.path.exists(crc):
                os.unlink(crc)
            spoilt += 1
    assert spoilt > 10 and expected > 0
    spark.catalog.refreshByPath(path)
    assert day.count() == expected  # a single other file would have failed the scan


def test_workers_need_no_installed_package(tmp_path):
    """Started elsewhere, the Python workers cannot import the package from disk."""
    script = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
print("rows", entry.queries()["extract_links"](spark, {SF_DIR!r}).count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]
