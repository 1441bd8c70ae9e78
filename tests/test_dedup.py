import random

from pyspark.sql import functions as F

from presslake.operators.coverage import coverage_report, missing_urls
from presslake.operators.dedup import (
    drop_known,
    duplicate_stats,
    first_wins,
    frontier_dedup,
    media_first_wins,
)
from presslake.plans.articles import merge_runs, new_articles


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 300)}", i, f"v{i}") for i in range(5000)]
    rng.shuffle(rows)
    best = {}
    for key, order, value in sorted(rows, key=lambda r: r[1]):
        best.setdefault(key, (order, value))
    df = spark.createDataFrame(rows, "k string, o long, v string").repartition(8)
    out = first_wins(df, ["k"], ["o"])
    assert out.columns == df.columns
    assert {r.k: (r.o, r.v) for r in out.collect()} == best


def test_first_wins_reduces_before_the_shuffle(spark):
    """The hot key reaches the exchange as one row per task."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(0, 8000, 1, 8).select(key.alias("k"), F.col("id").alias("o"))
    out = first_wins(df, ["k"], ["o"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("== Initial Plan ==")]
    partial = plan.index("row_number(), 1, Partial")
    assert partial > plan.index("Exchange")  # below it in the printed tree
    got = {r.k: r.o for r in out.collect()}
    assert got == {"hot": 0, **{str(i): i for i in range(8000) if i % 3}}


def test_runs(spark):
    rows = [("r2", 0, "a", "late"), ("r1", 5, "a", "early"), ("r2", 1, "b", "new"), ("r2", 2, "b", "again")]
    df = spark.createDataFrame(rows, "run_ts string, line_no long, article_id string, title string")
    merged = {r.article_id: r.title for r in merge_runs(df, ["run_ts", "line_no"]).collect()}
    assert merged == {"a": "early", "b": "new"}
    added = new_articles(df.filter("run_ts = 'r2'"), df.filter("run_ts = 'r1'"), ["line_no"])
    assert [r.title for r in added.collect()] == ["new"]


def test_drop_known_does_not_shuffle_a_big_archive(spark, tmp_path):
    archive_path = str(tmp_path / "archive")
    spark.range(200000).selectExpr("cast(id as string) as article_id").write.parquet(archive_path)
    archive = spark.read.parquet(archive_path)
    batch = spark.createDataFrame([("5",), ("x",)], "article_id string")
    out = drop_known(batch, archive)
    plan = plan_of(out)
    assert [r.article_id for r in out.collect()] == ["x"]
    final = plan[: plan.index("== Initial Plan ==")]
    assert "BroadcastHashJoin [article_id" in final and "LeftSemi" in final
    assert "SortMergeJoin" not in final


def test_media_first_wins(spark):
    rows = [(["a", "b", "a", None, None, "b", "c"],), ([],)]
    df = spark.createDataFrame(rows, "u array<string>").select(
        F.transform("u", lambda u: F.struct(u.alias("url"))).alias("media")
    )
    got = [[m.url for m in r.m] for r in df.select(media_first_wins(F.col("media")).alias("m")).collect()]
    assert got == [["a", "b", None, None, "c"], []]


def test_frontier_dedup(spark):
    rows = [(1, "http://x/%41"), (2, " http://x/A "), (3, "http://x/a+b"), (4, "http://x/A")]
    df = spark.createDataFrame(rows, "n long, url string")
    out = frontier_dedup(df, ["n"])
    got = {r.url_key: (r.url, r.n_seen) for r in out.collect()}
    assert got == {"http://x/A": ("http://x/%41", 3), "http://x/a+b": ("http://x/a+b", 1)}
    assert tuple(duplicate_stats(out).first()) == (4, 2, 2)


def test_missing_urls(spark):
    links = spark.createDataFrame(
        [("http://x/%D8%A7", 1), ("http://x/ا", 2), (" http://x/b ", 3), ("http://x/b", 4), ("", 5), (None, 6), ("http://x/a+b", 7)],
        "url string, rank int",
    )
    scraped = spark.createDataFrame([("http://x/ا",), ("http://x/ا ",), (None,), ("http://x/a b",)], "url string")
    assert sorted(r["rank"] for r in missing_urls(links, scraped).collect()) == [3, 4, 7]
    assert tuple(coverage_report(links, scraped).first()) == (2, 3)
    none = scraped.filter("url = 'nope'")
    assert tuple(coverage_report(links, none).first()) == (0, 5)
    assert tuple(coverage_report(none, scraped).first()) == (2, 0)


def test_a_hot_url_is_split_over_tasks(spark):
    """A third of the list is one URL: the join's skewed partition is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        url = F.when(F.col("id") % 3 == 0, "http://x/hot").otherwise(F.concat(F.lit("http://x/"), "id"))
        links = spark.range(0, 60000, 1, 8).select(url.alias("url"), F.col("id").alias("rank"))
        scraped = spark.range(0, 30000, 1, 4).select(F.concat(F.lit("http://x/"), F.col("id")).alias("url"))
        out = missing_urls(links, scraped)
        plan = plan_of(out)
        expected = sum(1 for i in range(60000) if i % 3 == 0 or i >= 30000)
        assert out.count() == expected
        assert "skewed" in plan[: plan.index("== Initial Plan ==")]
    finally:
        for key in settings:
            spark.conf.unset(key)
