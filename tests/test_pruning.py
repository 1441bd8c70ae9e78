import datetime as dt
import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from presslake.operators import search
from presslake.operators.search import candidate_files, content_search, write_content_index
from presslake.plans.clustering import interleaved, write_clustered


def test_bits_in_turn(spark):
    rng = random.Random(2)
    rows = [tuple(rng.randrange(1 << 16) for _ in range(3)) for _ in range(200)] + [(0, 0, 0), (65535,) * 3, (None, 1, 0)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    found = [r.z for r in df.select(interleaved([F.col("a"), F.col("b"), F.col("c")]).alias("z")).collect()]
    expected = [int("".join(f"{x:016b}{y:016b}{z:016b}"[i + 16 * k] for i in range(16) for k in range(3)), 2) for x, y, z in
                [(a or 0, b, c) for a, b, c in rows]]
    assert found == expected
    with pytest.raises(ValueError):
        interleaved([F.col("a")] * 4)


def groups_read(path, column, low, high):
    """Row groups whose statistics do not rule out a value from ``low`` to ``high``."""
    read = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_row_groups):
            group = meta.row_group(i)
            at = [group.column(c).path_in_schema for c in range(group.num_columns)].index(column)
            stats = group.column(at).statistics
            total += 1
            read += stats is None or not (stats.max < low or stats.min > high)
    return read, total


def test_row_groups_are_skipped_on_time_and_category(spark, tmp_path):
    rows = spark.range(20_000).selectExpr(
        "cast(id as string) as article_id",
        "concat('c', pmod(xxhash64(id), 16)) as category",
        "timestamp_ntz'2013-01-01 00:00:00' + make_dt_interval(cast(pmod(xxhash64(id, 1), 3650) as int)) as date_parsed",
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    rows.repartition(4).write.option("parquet.block.row.count.limit", "200").parquet(plain)
    write_clustered(rows, clustered, n_files=4, row_group_rows=200)
    assert sorted(spark.read.parquet(clustered).collect()) == sorted(rows.collect())
    year = (dt.datetime(2016, 1, 1), dt.datetime(2016, 12, 31))
    assert groups_read(plain, "date_parsed", *year)[0] == groups_read(plain, "date_parsed", *year)[1]
    read, total = groups_read(clustered, "date_parsed", *year)
    assert total >= 100 and read < total / 3
    read, total = groups_read(clustered, "category", "c7", "c7")
    assert read < total / 2


def test_clustered_nulls_and_empty(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, None), (None, "c", None)], "article_id string, category string, date_parsed timestamp_ntz")
    for name, df in (("some", rows), ("none", rows.limit(0))):
        write_clustered(df, str(tmp_path / name), n_files=2, row_group_rows=10)
        assert spark.read.schema(rows.schema).parquet(str(tmp_path / name)).count() == df.count()


@pytest.fixture
def searched(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "die"]) for _ in range(20))) for i in range(200)]
    rows += [(500, "a needle, näher 😀x 50%_ here"), (501, None), (502, ""), (503, "al")]
    path = str(tmp_path / "articles")
    spark.createDataFrame(rows, "id int, content string").repartitionByRange(10, "id").write.parquet(path)
    write_content_index(spark, path, str(tmp_path / "index"))
    return path, spark.read.parquet(str(tmp_path / "index"))


@pytest.mark.parametrize("word", ["needle", "näher 😀", "alpha beta", "die gamma die", "50%_", "al", "", "nowhere", "le, nä", "zzz"])
def test_the_same_rows_as_a_scan(spark, searched, word):
    path, index = searched
    every = spark.read.parquet(path).where(F.contains(F.col("content"), F.lit(word)))
    assert sorted(content_search(spark, path, index, word).collect()) == sorted(every.collect())


def test_few_files_are_opened(spark, searched):
    path, index = searched
    files = len(glob.glob(f"{path}/*.parquet"))
    assert files >= 8 and len(candidate_files(index, "needle")) == 1
    assert candidate_files(index, "nowhere") == [] and candidate_files(index, "al") is None
    opened = content_search(spark, path, index, "needle").inputFiles()
    assert [os.path.basename(f) for f in opened] == [os.path.basename(f) for f in candidate_files(index, "needle")]
    assert len(candidate_files(index, "alpha")) >= files - 2


def test_the_index_holds_the_runs_of_each_file_and_no_others(spark, tmp_path, monkeypatch):
    """Runs never cross texts or cut a character in two, wherever the texts are cut for work."""
    monkeypatch.setattr(search, "CHUNK", 7)
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab é😀日\n") for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, "", "ab", "😀😀", "abcabcabc"]
    path, index = str(tmp_path / "articles"), str(tmp_path / "index")
    spark.createDataFrame(list(enumerate(texts)), "id int, content string").repartitionByRange(4, "id").write.parquet(path)
    write_content_index(spark, path, index)
    expected = set()
    for r in spark.read.parquet(path).selectExpr("_metadata.file_path as file", "content").where("content is not null").collect():
        expected |= {(r.content[i : i + 3], r.file) for i in range(len(r.content) - 2)}
    found = [(r.gram, file) for r in spark.read.parquet(index).collect() for file in r.files]
    assert sorted(found) == sorted(expected)
