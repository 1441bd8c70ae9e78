import pytest

from presslake.sources.files import scan_lines
from presslake.sources.numbered import line_slice, with_line_numbers

FILES = {
    "a.txt": ["", "one", "", *(f"line {i} " + "x" * (i * 7 % 90) for i in range(400)), ""],
    "b.txt": ["y" * 5000, *(f"b{i}" for i in range(50)), "z" * 3000],
    "c.txt": ["only"],
}


@pytest.fixture
def folder(tmp_path):
    for name, lines in FILES.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path)


@pytest.mark.parametrize("split", ["100", "777", "128m"])
def test_numbers_of_split_files(spark, folder, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = with_line_numbers(scan_lines(spark, folder)).collect()
        part = line_slice(spark, folder, 45, 60).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, lines in FILES.items():
        own = {r.line_no: r.value for r in rows if r.src_path.endswith(name)}
        assert own == dict(enumerate(lines))
        assert {r.line_no: r.value for r in part if r.src_path.endswith(name)} == dict(list(enumerate(lines))[45:60])
    assert len(rows) == sum(map(len, FILES.values()))


def test_missing_and_empty_input(spark, tmp_path):
    assert with_line_numbers(scan_lines(spark, str(tmp_path / "none"))).count() == 0
    (tmp_path / "empty.txt").write_text("")
    assert line_slice(spark, str(tmp_path / "empty.txt"), 0, 5).count() == 0
