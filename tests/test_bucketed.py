import json

import pytest

from presslake.sources.files import list_files
from presslake.streaming.bucketed import ingest_bucketed, known_ids, open_archive, read_bucketed
from presslake.streaming.ingest import ingest, read_archive

DATE = "1 يناير 2015 12:05 ص"


def record(i, title):
    return json.dumps({"article_id": i, "url": f"u{i}", "title": title, "publish_date": DATE})


def land(path, *lines):
    path.mkdir(parents=True)
    (path / "part-0.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")


def rows(spark, archive):
    return sorted((r.article_id, r.title, r.batch) for r in read_bucketed(spark, archive).collect())


def test_runs_replay_and_resume(spark, tmp_path):
    raw, check = tmp_path / "raw", str(tmp_path / "check")
    archive = open_archive(spark, str(tmp_path / "out"), shelves=4, buckets=2)
    assert rows(spark, archive) == []
    land(raw / "urgent_1.jsonl", record(1, "a"), "broken", record(1, "late"), record(2, "b"))
    ingest_bucketed(spark, str(raw), archive, check)
    land(raw / "urgent_2.jsonl", record(2, "changed"), record(3, "c"))
    ingest_bucketed(spark, str(raw), archive, check)
    expected = [("1", "a", 0), ("2", "b", 0), ("3", "c", 1)]
    assert rows(spark, archive) == expected
    ingest_bucketed(spark, str(raw), archive, check)  # nothing new
    # The last batch was written but its commit got lost: it runs again.
    (tmp_path / "check" / "commits" / "1").unlink()
    crc = tmp_path / "check" / "commits" / ".1.crc"
    if crc.exists():
        crc.unlink()
    ingest_bucketed(spark, str(raw), archive, check)
    assert rows(spark, archive) == expected
    assert all(r.date_parsed.year == 2015 for r in read_bucketed(spark, archive).collect())


def test_equals_the_plain_archive(spark, tmp_path):
    raw = tmp_path / "raw"
    archive = open_archive(spark, str(tmp_path / "out"), shelves=3, buckets=5)
    for run in range(3):
        land(raw / f"urgent_{run}.jsonl", *(record(i, f"run{run}") for i in range(run * 20, run * 20 + 50)))
        ingest_bucketed(spark, str(raw), archive, str(tmp_path / "check"), max_files_per_batch=1)
        ingest(spark, str(raw), str(tmp_path / "plain"), str(tmp_path / "plain-check"), max_files_per_batch=1)
    plain = sorted((r.article_id, r.title, r.batch) for r in read_archive(spark, str(tmp_path / "plain")).collect())
    assert rows(spark, archive) == plain and len(plain) == 90
    files = list_files(spark, [str(tmp_path / "out")])
    assert len(files) <= 3 * 3 * 5  # batches, shelves, buckets


def test_layout_is_kept(spark, tmp_path):
    path = str(tmp_path / "out")
    land(tmp_path / "raw" / "a_1.jsonl", record(1, "a"))
    ingest_bucketed(spark, str(tmp_path / "raw"), open_archive(spark, path, shelves=4, buckets=2), str(tmp_path / "check"))
    spark.sql(f"drop table {open_archive(spark, path).table}")  # as in another session
    again = open_archive(spark, path, shelves=9, buckets=9)
    assert (again.shelves, again.buckets) == (4, 2) and rows(spark, again) == [("1", "a", 0)]
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError):
        open_archive(spark, str(tmp_path / "other"))


def test_archive_is_not_shuffled(spark, tmp_path):
    archive = open_archive(spark, str(tmp_path / "out"), shelves=4, buckets=8)
    land(tmp_path / "raw" / "a_1.jsonl", *(record(i, "a") for i in range(100)))
    ingest_bucketed(spark, str(tmp_path / "raw"), archive, str(tmp_path / "check"))
    ids = spark.createDataFrame([("1",), ("2",), ("x",)], "article_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = known_ids(archive, ids, 1)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r[0] for r in found.collect()) == ["1", "2"]
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange") == 1
    side = plan[: plan.index("FileScan")]
    assert "Exchange" not in side  # the one exchange is on the side of the batch
    assert known_ids(archive, ids, 0).count() == 0


def test_a_batch_opens_only_the_files_of_its_shelves(spark, tmp_path):
    raw, check, out = tmp_path / "raw", str(tmp_path / "check"), tmp_path / "out"
    archive = open_archive(spark, str(out), shelves=8, buckets=2)
    land(raw / "a_1.jsonl", *(record(i, "a") for i in range(200)))
    ingest_bucketed(spark, str(raw), archive, check)
    shelf = spark.createDataFrame([("7",)], "article_id string").select(archive.shelf()).first()[0]
    spoilt = kept = 0
    for file in out.glob("batch=0/shelf=*/*.parquet"):
        if file.parent.name == f"shelf={shelf}":
            kept += 1
            continue
        file.write_bytes(b"no parquet")
        crc = file.parent / f".{file.name}.crc"
        if crc.exists():
            crc.unlink()
        spoilt += 1
    assert kept and spoilt > 3 * kept
    land(raw / "a_2.jsonl", record(7, "late"))
    ingest_bucketed(spark, str(raw), archive, check)  # a look at any other shelf would fail
    assert spark.table(archive.table).where(f"shelf = {shelf} and article_id = '7'").count() == 1
