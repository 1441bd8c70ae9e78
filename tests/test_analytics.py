import datetime as dt
import math
import random
import statistics

from pyspark.sql import functions as F

from presslake.operators import analytics


def test_tags(spark):
    rows = [(["a", "b", None],), (["a", ""],), ([],), (None,), (["b", "a"],)]
    df = spark.createDataFrame(rows, "tags array<string>")
    assert [tuple(r) for r in analytics.top_tags(df, 2).collect()] == [("a", 3), ("b", 2)]
    assert [r.share for r in analytics.top_tags_share(df, 2).orderBy("tag").collect()] == [0.6, 0.4]
    plan = analytics.top_tags(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan


def test_heatmap_keeps_unparsed_dates_as_a_group(spark):
    rows = [(dt.datetime(2024, 1, 7, 23, 5),), (None,), (None,), (dt.datetime(2024, 1, 7, 23, 59),)]
    df = spark.createDataFrame(rows, "date_parsed timestamp_ntz")
    got = {(r.weekday, r.hour): r.article_count for r in analytics.heatmap(df).collect()}
    assert got == {(7, 23): 2, (None, None): 2}
    wide = {r.weekday: r for r in analytics.heatmap_pivot(df).collect()}
    assert wide[7].h23 == 2 and wide[7].h0 == 0 and len(wide[7]) == 25


def test_unique_rows_and_distinct(spark):
    rows = [("a", None, [1]), ("a", None, [1]), (None, "a", [1]), ("a", "", [1]), ("a", None, None), ("a", None, [])]
    df = spark.createDataFrame(rows, "x string, y string, z array<int>")
    assert analytics.n_unique_rows(df).first().n_unique == df.distinct().count() == 5
    assert {r.x for r in analytics.distinct_values(df, "x").collect()} == {"a", None}
    assert tuple(analytics.column_counts(df).first()) == (5, 2, 5)
    assert analytics.shape(df) == (6, 3)


def test_unique_rows_see_microseconds_and_zeros(spark):
    rows = [("2024-01-01 00:00:00.000001", 0.0), ("2024-01-01 00:00:00.000002", 0.0), ("2024-01-01 00:00:00.000001", -0.0)]
    df = spark.createDataFrame(rows, "t string, x double")
    for kind in ("timestamp", "timestamp_ntz"):
        assert analytics.n_unique_rows(df.withColumn("t", F.col("t").cast(kind))).first().n_unique == 2


def test_head_and_batches(spark):
    df = spark.range(1000).withColumn("k", 1000 - F.col("id")).repartition(7)
    assert [r.k for r in analytics.head(df, 3, ["k"]).collect()] == [1, 2, 3]
    batches = list(analytics.in_batches(df, 300))
    assert [len(b) for b in batches] == [300, 300, 300, 100]
    assert {r.id for b in batches for r in b} == set(range(1000))


def nearest(values, p):
    ordered = sorted(values)
    return ordered[math.floor((len(ordered) - 1) * p + 0.5)]


def test_exact_quantiles(spark):
    rng = random.Random(5)
    samples = {
        "one": [4],
        "two": [1, 2],
        "spread": [rng.randint(-(10**9), 10**9) for _ in range(20001)],
        "hot": [7 if rng.random() < 0.4 else rng.randint(0, 10**6) for _ in range(20000)],
        "constant": [3] * 1000,
    }
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    for values in samples.values():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long").repartition(5)
        want = [nearest(values, p) for p in probabilities]
        assert analytics.exact_quantiles(df, {"v": probabilities})[0] == {"v": want}
        # a margin too small to hold the ranks is widened until it does
        assert analytics.exact_quantiles(df, {"v": probabilities}, margin=1e-9)[0] == {"v": want}
    assert analytics.exact_quantiles(df.filter("v > 3"), {"v": [0.5]})[0] == {"v": [None]}


def test_quantiles_of_several_columns_in_three_passes(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.random(), rng.randint(0, 99), dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**12)))
            for _ in range(5000)]
    df = spark.createDataFrame(rows, "x double, n int, t timestamp_ntz").repartition(4)
    wanted = {"x": [0.1, 0.5], "n": [0.5], "t": [0.0, 0.9]}
    want = {c: [nearest([r[i] for r in rows], p) for p in wanted[c]] for i, c in enumerate(wanted)}
    found, stats = analytics.exact_quantiles(df, wanted, stats=[F.count("*").alias("rows")])
    assert (found, stats) == (want, {"rows": 5000})
    monkeypatch.setattr(analytics, "RANKED_VALUES", 20)  # ranges must be narrowed first
    assert analytics.exact_quantiles(df, wanted, margin=0.2)[0] == want


def test_describe(spark):
    values = [1.0, 2.5, None, 10.0, 3.0]
    days = [dt.datetime(2024, 1, d, 12) for d in (1, 2, 3, 4, 5)]
    rows = [(v, d, f"s{i}" if i else None, [f"t{i}"]) for i, (v, d) in enumerate(zip(values, days))]
    df = spark.createDataFrame(rows, "n double, d timestamp_ntz, s string, l array<string>")
    got = {r.statistic: r for r in analytics.describe(df).collect()}
    assert list(got) == list(analytics.STATISTICS)
    numbers = [v for v in values if v is not None]
    assert got["count"].n == 4 and got["null_count"].n == 1
    assert got["mean"].n == round(statistics.mean(numbers), 6)
    assert got["std"].n == round(statistics.stdev(numbers), 6)
    assert (got["min"].n, got["25%"].n, got["50%"].n, got["75%"].n, got["max"].n) == (1.0, 2.5, 3.0, 3.0, 10.0)
    assert got["mean"].d == "2024-01-03 12:00:00" and got["25%"].d == "2024-01-02 12:00:00" and got["std"].d is None
    assert (got["min"].s, got["max"].s, got["mean"].s, got["null_count"].s) == ("s1", "s4", None, "1")
    assert (got["count"].l, got["min"].l) == ("5", None)


def test_quality_and_sql(spark):
    rows = [("u1", "", None), ("u2", "xالحملy", "a"), ("u3", None, None), ("u4", "z", "b")]
    df = spark.createDataFrame(rows, "url string, content string, author string")
    got = sorted((r.issue, r.url) for r in analytics.quality_issues(df).collect())
    assert got == [("empty_content", "u1"), ("no_author", "u1"), ("no_author", "u3")]
    assert [r.content for r in analytics.content_like(df, "الحمل").collect()] == ["xالحملy"]
    literal = spark.createDataFrame([("100% sure",), ("1000 sure",)], "content string")
    assert [r.content for r in analytics.content_like(literal, "100% s").collect()] == ["100% sure"]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(100).selectExpr(
        "cast(id as string) as url", "'x' as content", "'a' as author", "timestamp_ntz'2015-01-01 00:00:00' as date_parsed"
    ).write.parquet(path)
    df = spark.read.parquet(path)

    def plan(query):
        return query._jdf.queryExecution().executedPlan().toString()

    from presslake.functions.dates import before_year

    text = plan(df.filter(before_year(F.col("date_parsed"), 2016)).select("url"))
    assert "LessThan(date_parsed" in text and "ReadSchema: struct<url:string,date_parsed:timestamp_ntz>" in text
    text = plan(analytics.content_like(df, "abc"))
    assert "StringContains(content,abc)" in text and "ReadSchema: struct<content:string>" in text
    text = plan(df.filter(F.col("author").isNull()).select("url"))
    assert "IsNull(author)" in text
