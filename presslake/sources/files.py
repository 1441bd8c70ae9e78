"""Line-oriented inputs: JSON-lines feeds and URL lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslake.functions.text import ustrip
from presslake.functions.variants import enclosed, read_enclosed

# Where a line stands: file, split of the file, row within the split. Sorting by
# these restores the line order of every file; the numbers are no line numbers.
POSITION = ["src_path", "src_block", "src_row"]
LINES_DDL = "value string, src_path string, src_block long, src_row long"


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The given paths (globs allowed) that match something."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for name in paths:
        path = hadoop.Path(name)
        if len(path.getFileSystem(conf).globStatus(path) or ()) > 0:
            found.append(name)
    return found


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """All data files below the given paths (globs allowed), in order of their path."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    todo = [
        (path.getFileSystem(conf), status)
        for path in map(hadoop.Path, existing(spark, paths))
        for status in path.getFileSystem(conf).globStatus(path)
    ]
    found = []
    while todo:
        fs, status = todo.pop()
        if status.isFile():
            found.append(status.getPath().toString())
            continue
        children = fs.listStatus(status.getPath())
        todo += [(fs, child) for child in children if child.getPath().getName()[0] not in "_."]
    return sorted(found)


def scan_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their position; a missing input counts as empty."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    found = existing(spark, wanted)
    if not found:
        return spark.createDataFrame([], LINES_DDL)
    return spark.read.text(found).select(
        "value",
        F.col("_metadata.file_path").alias("src_path"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    )


def with_source_name(lines: DataFrame, suffix: str = "jsonl") -> DataFrame:
    """``src_file``: base name of the input without its suffix.

    The input may be one file ``arab.jsonl`` or a folder of part files
    ``arab.jsonl/`` (or ``...=arab.jsonl/``).
    """
    name = F.regexp_extract("src_path", rf"([^/=]+)\.{suffix}(?:/[^/]*)?$", 1)
    return lines.withColumn("src_file", name)


def records(lines: DataFrame, fields: str, value: str = "value") -> DataFrame:
    """Lines that are one JSON object: other columns of ``lines``, then ``r``.

    ``fields`` is a struct DDL such as ``url: string``; a field of another type
    is NULL. A generator keeps filters on ``r`` from parsing the line twice.
    """
    read = f"explode(array({read_enclosed(enclosed(value), fields)})) as x"
    parsed = lines.selectExpr("*", read).filter("x.end = 0 and x.r is not null")
    return parsed.select(*lines.columns, "x.r")


def scan_jsonl(spark: SparkSession, paths: str | Sequence[str], fields: str) -> DataFrame:
    """Records (JSON objects) read with the given fields, plus their position.

    Blank, malformed and other lines are skipped.
    """
    return records(scan_lines(spark, paths), fields).select("r.*", *POSITION)


def scan_url_list(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``url`` of a JSON-lines list, with the whole ``value`` line; no empty URLs."""
    return urls_of_lines(scan_lines(spark, paths).select("value"))


def urls_of_lines(lines: DataFrame) -> DataFrame:
    """Lines that carry a non-empty ``url``, stripped, with that URL."""
    stripped = lines.withColumn("value", ustrip("value"))
    return records(stripped, "url: string").filter("r.url <> ''").select(*lines.columns, "r.url")


def scan_url_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``url`` of a plain list, one per line; blank lines are skipped."""
    lines = scan_lines(spark, paths)
    return lines.select(ustrip("value").alias("url")).filter("url <> ''")


def scan_limit(spark: SparkSession, paths: str | Sequence[str], n_lines: int) -> DataFrame:
    """The first ``n_lines`` input lines in file order, blank lines included.

    Files are taken in order, twice as many in each step, until they hold enough
    lines; later files are never opened. Every task keeps only its own first lines.
    """
    files = list_files(spark, [paths] if isinstance(paths, str) else list(paths))
    chosen, missing, step = scan_lines(spark, files[:1]).limit(0), n_lines, 1
    while files and missing > 0:
        part = scan_lines(spark, files[:step]).orderBy(*POSITION).limit(missing)
        chosen, missing = chosen.unionByName(part), missing - part.count()
        files, step = files[step:], 2 * step
    return chosen
