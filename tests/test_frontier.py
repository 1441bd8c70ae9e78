import json
import time

from presslake.streaming.frontier import next_requests, read_requests, start_requests


def land(path, *urls):
    path.mkdir(parents=True)
    (path / "part-0.txt").write_text("\n".join(json.dumps({"url": u}) for u in urls) + "\n", encoding="utf-8")


def requests(spark, target):
    return sorted(r.url for r in read_requests(spark, target).collect())


def test_runs_ask_for_nothing_twice(spark, tmp_path):
    found, target, check = tmp_path / "found", str(tmp_path / "out"), str(tmp_path / "check")
    assert requests(spark, target) == []
    land(found / "1.jsonl", "http://a.com/x?b=1&a=2", "HTTP://A.com:80/x?a=2&b=1#y", "http://a.com/z", "")
    next_requests(spark, str(found), target, check)
    expected = ["http://a.com/x?a=2&b=1", "http://a.com/z"]
    assert requests(spark, target) == expected
    land(found / "2.jsonl", "http://a.com/./z", "http://a.com/w")
    next_requests(spark, str(found), target, check)
    next_requests(spark, str(found), target, check)  # nothing new
    assert requests(spark, target) == ["http://a.com/w", *expected]


def test_a_batch_without_commit_runs_again(spark, tmp_path):
    found, target, check = tmp_path / "found", str(tmp_path / "out"), str(tmp_path / "check")
    for run in range(3):
        land(found / f"{run}.jsonl", *(f"http://a.com/{i}" for i in range(run * 5, run * 5 + 10)))
        next_requests(spark, str(found), target, check)
        last = max(int(p.name) for p in (tmp_path / "check" / "commits").iterdir() if p.name.isdigit())
        (tmp_path / "check" / "commits" / str(last)).unlink()
        crc = tmp_path / "check" / "commits" / f".{last}.crc"
        if crc.exists():
            crc.unlink()
    next_requests(spark, str(found), target, check)
    assert requests(spark, target) == sorted(f"http://a.com/{i}" for i in range(20))


def test_stopped_anywhere(spark, tmp_path):
    """Runs of one file a batch, stopped after different times, then finished."""
    found, target, check = tmp_path / "found", str(tmp_path / "out"), str(tmp_path / "check")
    for n in range(6):
        land(found / f"{n}.jsonl", *(f"http://a.com/{i}" for i in range(n * 3, n * 3 + 8)))
    for pause in (0, 0.5, 1.5, 3):
        query = start_requests(spark, str(found), target, check, max_files_per_batch=1)
        time.sleep(pause)
        query.stop()
    next_requests(spark, str(found), target, check, max_files_per_batch=1)
    assert requests(spark, target) == sorted(f"http://a.com/{i}" for i in range(23))
