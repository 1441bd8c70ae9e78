import csv
import datetime as dt
import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from presslake.operators.dedup import first_wins
from presslake.operators.normalize import normalize
from presslake.plans import articles as plans
from presslake.schema import CATEGORY_LABELS, SECTIONS
from presslake.operators import links
from presslake.session import scratch_dir, scratch_root
from presslake.sinks import files as sinks
from presslake.sources import files as sources


def record(i, **extra):
    return json.dumps({"article_id": i, "url": f"u{i}", **extra}, ensure_ascii=False)


def write(path, *lines, encoding="utf-8"):
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return str(path)


def test_missing_input_is_empty(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere.jsonl")
    assert sources.scan_lines(spark, nowhere).count() == 0
    assert sources.scan_url_list(spark, nowhere).count() == 0
    assert sources.scan_url_text(spark, nowhere).count() == 0
    there = write(tmp_path / "a.txt", "x")
    assert sources.scan_url_text(spark, [nowhere, there]).count() == 1


def test_bom_blank_and_malformed_lines(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", record(1), "", "{", "5", "[1]", record(2) + " x", record(2) * 2, record(3), encoding="utf-8-sig")
    rows = sources.scan_jsonl(spark, path, "article_id: string, url: string").collect()
    assert [(r.article_id, r.url) for r in rows] == [("1", "u1"), ("3", "u3")]


def test_url_lists(spark, tmp_path):
    path = write(tmp_path / "l.jsonl", ' {"url": "a b "}\t', "", '{"url": ""}', '{"url": null}', '{"u": "x"}', "{", '{"url": "ا", "rank": 1}')
    assert [r.url for r in sources.scan_url_list(spark, path).collect()] == ["a b ", "ا"]
    path = write(tmp_path / "l.txt", "  a ", "", " ", "b\t")
    assert [r.url for r in sources.scan_url_text(spark, path).collect()] == ["a", "b"]


def test_scan_limit_counts_blank_lines(spark, tmp_path):
    path = write(tmp_path / "l.txt", "a", "", "b", "c")
    assert [r.value for r in sources.scan_limit(spark, path, 3).collect()] == ["a", "", "b"]


def test_scan_limit_opens_no_later_files(spark, tmp_path):
    for i in range(9):
        write(tmp_path / f"{i}.txt", f"{i}a", f"{i}b")
    rows = sources.scan_limit(spark, str(tmp_path), 3)
    assert [r.value for r in rows.collect()] == ["0a", "0b", "1a"]
    assert not any(f.endswith("4.txt") for f in rows.inputFiles())
    assert sources.scan_limit(spark, str(tmp_path), 100).count() == 18
    assert sources.scan_limit(spark, str(tmp_path / "nowhere"), 3).count() == 0


def test_first_line_wins_across_splits_of_one_file(spark, tmp_path):
    lines = [record(i % 50, title=f"t{i}", content="x" * 200) for i in range(5000)]
    path = write(tmp_path / "big.jsonl", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        scan = sources.scan_lines(spark, path)
        assert scan.rdd.getNumPartitions() > 8
        rows = first_wins(normalize(scan), ["src_path", "article_id"], sources.POSITION).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.article_id: r.title for r in rows} == {str(i): f"t{i}" for i in range(50)}


def test_convert_dedups_per_file(spark, tmp_path):
    write(tmp_path / "a.jsonl", record(1, title="x"), record(1, title="y"))
    write(tmp_path / "b.jsonl", record(1, title="z"), record(2, title="w"))
    out = str(tmp_path / "out")
    plans.convert(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")], out)
    assert sorted(r.title for r in spark.read.parquet(out).collect()) == ["w", "x", "z"]
    plans.convert(spark, str(tmp_path / "a.jsonl"), out + "2", dedup=False)
    assert sorted(r.title for r in spark.read.parquet(out + "2").collect()) == ["x", "y"]


def test_convert_without_valid_rows_gives_an_empty_dataset(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", "{", "null")
    plans.convert(spark, path, str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 0 and len(stored.columns) == 9


def test_source_names(spark, tmp_path):
    write(tmp_path / "arab.jsonl", record(1))
    (tmp_path / "src=art.jsonl").mkdir()
    write(tmp_path / "src=art.jsonl" / "part-0.txt", record(2))
    scan = sources.scan_lines(spark, [str(tmp_path / "arab.jsonl"), str(tmp_path / "src=art.jsonl")])
    names = {r.src_file for r in sources.with_source_name(scan).collect()}
    assert names == {"arab", "art"}


def test_row_groups_and_compression(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(spark.range(12000).coalesce(1), path, row_group_rows=5000)
    (part,) = glob.glob(f"{path}/*.parquet")
    meta = pq.ParquetFile(part).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [5000, 5000, 2000]
    assert meta.row_group(0).column(0).compression == "SNAPPY"


def test_csv_has_bom_header_and_quotes(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [("u1", 'a "q", b\nc'), ("u2", ""), ("u3", None)]
    df = spark.createDataFrame(rows, "url string, content string")
    sinks.write_csv(df.coalesce(1), path)
    (part,) = glob.glob(f"{path}/part-*.csv")
    raw = open(part, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfurl,content\n")
    assert b'"a ""q"", b\nc"' in raw
    back = sinks.read_csv(spark, path, "url string, content string").collect()
    assert [tuple(r) for r in back] == rows


def test_csv_keeps_every_character(spark, tmp_path):
    values = ["  x ", "\ta", "#c", '"', '""', "a\\", "\\\"b", "x\r\ny", "\n", "،ق", ",", "'", " ", "\u00a0"]
    df = spark.createDataFrame([(f"u{i}", v) for i, v in enumerate(values)], "url string, content string")
    path = str(tmp_path / "c")
    sinks.write_csv(df, path)
    back = {r.url: r.content for r in sinks.read_csv(spark, path, "url string, content string").collect()}
    assert back == {f"u{i}": v for i, v in enumerate(values)}
    # any other reader of quoted CSV sees the same
    other = {}
    for part in glob.glob(f"{path}/part-*.csv"):
        with open(part, encoding="utf-8-sig", newline="") as handle:
            header, *rows = csv.reader(handle)
            assert header == ["url", "content"]
            other.update(rows)
    assert other == back


def test_enrich_in_place(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.createDataFrame([("1", "1 يناير 2015 12:05 ص"), ("2", None)], "article_id string, publish_date string")
    sinks.write_parquet(df, path)
    assert plans.enrich_in_place(spark, path) is True
    assert plans.enrich_in_place(spark, path) is False
    got = {r.article_id: r.date_parsed for r in spark.read.parquet(path).collect()}
    assert got == {"1": dt.datetime(2015, 1, 1, 0, 5), "2": None}
    assert [os.path.basename(p) for p in glob.glob(f"{path}*")] == ["d"]


def test_rewrite_keeps_partition_folders(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = [("1", "x", "001"), ("2", "y", "a b"), ("3", "z", None)]
    sinks.write_parquet(spark.createDataFrame(rows, "id string, v string, part string"), path, partition_by=["part"])
    folders = sorted(os.path.basename(f) for f in glob.glob(f"{path}/part=*"))
    sinks.rewrite_in_place(spark, path, lambda df: df.withColumn("w", F.upper("v")))
    assert sorted(os.path.basename(f) for f in glob.glob(f"{path}/part=*")) == folders
    assert "part=001" in folders
    assert sorted((r.id, r.w) for r in spark.read.parquet(path).collect()) == [("1", "X"), ("2", "Y"), ("3", "Z")]


def test_a_stopped_rewrite_is_put_back(spark, tmp_path):
    path = tmp_path / "d"
    sinks.write_parquet(spark.range(5), str(path))
    path.rename(tmp_path / "d.old-0123456789ab")  # the process ended between the two renames
    sinks.rewrite_in_place(spark, str(path), lambda df: df.withColumn("x", F.lit(1)))
    assert spark.read.parquet(str(path)).where("x = 1").count() == 5
    assert [os.path.basename(p) for p in glob.glob(f"{path}*")] == ["d"]


def test_failed_rewrite_leaves_the_dataset(spark, tmp_path):
    path = str(tmp_path / "d")
    sinks.write_parquet(spark.range(5), path)
    with pytest.raises(Exception):
        sinks.rewrite_in_place(spark, path, lambda df: df.select(F.raise_error(F.lit("no")).alias("x")))
    assert spark.read.parquet(path).count() == 5
    assert [os.path.basename(p) for p in glob.glob(f"{path}*")] == ["d"]


def test_missing_list_is_a_valid_list_again(spark, tmp_path):
    wanted = write(tmp_path / "w.jsonl", *(json.dumps({"url": f"http://x/%D8%A7/{i % 8}", "rank": i}) for i in range(10)))
    have = write(tmp_path / "h.jsonl", '{"url": "http://x/ا/3", "title": "t"}')
    out = str(tmp_path / "missing.jsonl")
    plans.write_missing(spark, wanted, have, out)
    again = str(tmp_path / "again.jsonl")
    plans.write_missing(spark, out, have, again)
    first = sorted(r.value for r in spark.read.text(out).collect())
    assert len(first) == 9 and first == sorted(r.value for r in spark.read.text(again).collect())
    assert all("rank" in json.loads(v) for v in first)


def test_frontier_seed_and_categories(spark):
    sections = links.section_dimension(spark)
    pages = links.frontier(sections, "https://www.example.com")
    per = {r.section: r.n for r in pages.groupBy("section").agg(F.count("*").alias("n")).collect()}
    assert per == {key: hi - lo + 1 for key, _, lo, hi in SECTIONS}
    assert sum(per.values()) == 61416
    assert pages.filter("url = 'https://www.example.com/Section/فن/48/11'").count() == 1
    assert pages.select("url").distinct().count() == 61416
    tasks = pages.groupBy(F.spark_partition_id().alias("task")).count()
    assert tasks.count() > 4 and tasks.agg(F.max("count")).first()[0] < 61416 / 2
    (seed,) = links.seed_urls(sections, "https://h", "urgent").collect()
    assert seed.url == "https://h/Section/أخبار-عاجلة/65/1"
    for key in ("art", "nope", None):
        assert links.seed_urls(sections, "https://h", key).count() == 0
    assert [links.require_category(key) for key in CATEGORY_LABELS] == list(CATEGORY_LABELS)
    for key in ("", None, "nope"):
        with pytest.raises(ValueError):
            links.require_category(key)


def test_scratch_follows_the_session_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == shared
    assert scratch_dir(spark, "a").startswith(shared + "/presslake-run-")
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")
