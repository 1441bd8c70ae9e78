import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presslake.operators.analytics import heatmap, top_tags
from presslake.operators.coverage import coverage_estimate, url_sketches
from presslake.operators.heavy_hitters import heavy_hitters, summarised, top_tags_sketch
from presslake.plans.partials import HEATMAP_DDL, fold_parts, merged_heatmap, merged_top_tags, put_heatmap, put_tag_counts


def tagged(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        if rng.random() < 0.1:
            rows.append((rng.choice([None, []]),))
        else:
            rows.append(([f"t{min(int(rng.expovariate(0.2)), 60)}", f"rare{rng.randrange(5000)}", None],))
    return spark.createDataFrame(rows, "tags array<string>").repartition(7)


@pytest.mark.parametrize("capacity", [1, 8, 40, 10_000])
@pytest.mark.parametrize("k", [1, 5, 20])
def test_top_tags_with_small_summaries(spark, capacity, k):
    rows = tagged(spark, 3000, capacity)
    assert top_tags_sketch(rows, k, capacity).collect() == top_tags(rows, k).collect()


def test_ties_and_few_values(spark):
    rows = spark.createDataFrame([([t],) for t in "abcdefgh" * 20 + "zz"], "tags array<string>").repartition(5)
    for k in (3, 8, 9, 50):
        assert top_tags_sketch(rows, k, 2).collect() == top_tags(rows, k).collect()
    assert top_tags_sketch(rows.limit(0), 5).count() == 0


def test_a_task_sends_no_more_than_its_room(spark):
    values = tagged(spark, 4000, 3).select(F.explode("tags").alias("tag"))
    tasks = values.rdd.getNumPartitions()
    assert summarised(values, "tag", 10).count() <= 11 * tasks
    assert heavy_hitters(values, "tag", 3, 50).first()["value"] == "t0"


def batch(spark, ids):
    start = dt.datetime(2024, 1, 1)
    rows = [(str(i), start + dt.timedelta(hours=i * 5) if i % 9 else None, [f"t{i % 4}"]) for i in ids]
    return spark.createDataFrame(rows, "article_id string, date_parsed timestamp_ntz, tags array<string>")


def counted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_parts_replays_and_folds(spark, tmp_path):
    maps, tags = str(tmp_path / "maps"), str(tmp_path / "tags")
    assert merged_heatmap(spark, maps).count() == 0
    for n in range(6):
        for _ in range(1 + n % 2):  # some batches run twice
            put_heatmap(batch(spark, range(n * 40, n * 40 + 40 + n)), maps, n)
            put_tag_counts(batch(spark, range(n * 40, n * 40 + 40 + n)), tags, n)
        if n in (2, 4):
            fold_parts(spark, maps, HEATMAP_DDL)
    every = [i for n in range(6) for i in range(n * 40, n * 40 + 40 + n)]
    whole = batch(spark, every)
    assert counted(merged_heatmap(spark, maps)) == counted(heatmap(whole))
    assert merged_top_tags(spark, tags, 3).collect() == top_tags(whole, 3).collect()
    put_heatmap(batch(spark, range(5)), maps, 5)  # the last batch comes again, with other rows
    again = batch(spark, [i for i in every if i < 200] + [200, 201, 202, 203] + list(range(5)))
    assert sum(r.article_count for r in merged_heatmap(spark, maps).collect()) == again.count()
    left = sorted(p.name for p in (tmp_path / "maps").iterdir())
    assert left == ["base=000000000003", "batch=000000000004", "batch=000000000005"]


def test_a_fold_may_stop_anywhere(spark, tmp_path):
    path = str(tmp_path / "maps")
    for n in range(4):
        put_heatmap(batch(spark, range(n * 10, n * 10 + 10)), path, n)
    expected = counted(merged_heatmap(spark, path))
    kept = {p.name: {f.name: f.read_bytes() for f in p.iterdir()} for p in (tmp_path / "maps").iterdir()}
    fold_parts(spark, path, HEATMAP_DDL)
    for name, files in kept.items():  # what the fold removed is still there
        (tmp_path / "maps" / name).mkdir(exist_ok=True)
        for file, data in files.items():
            (tmp_path / "maps" / name / file).write_bytes(data)
    assert counted(merged_heatmap(spark, path)) == expected
    (tmp_path / "maps" / "base=000000000003").mkdir()  # a base that was never finished
    assert counted(merged_heatmap(spark, path)) == expected
    fold_parts(spark, path, HEATMAP_DDL)
    assert counted(merged_heatmap(spark, path)) == expected


@pytest.mark.parametrize("n", [100, 5_000, 120_000])
def test_estimates_lie_within_the_margin(spark, n):
    listed = spark.range(n).select((F.col("id") % 3).alias("run"), F.concat(F.lit("http://a/"), F.col("id")).alias("url"))
    scraped = spark.range(n // 2, n + n // 4).select((F.col("id") % 2).alias("run"), F.concat(F.lit("http://a/"), F.col("id")).alias("url"))
    for lg in (8, 12, 16):
        row = coverage_estimate(url_sketches(listed, "run", lg_entries=lg), url_sketches(scraped, "run", lg_entries=lg), lg).first()
        exact = (n, n + n // 4 - n // 2, n // 2, n - n // 2)
        assert all(abs(got - want) <= row.margin for got, want in zip(row[:4], exact))
        assert (row.margin == 0) == (n + n // 4 < 1 << lg)
