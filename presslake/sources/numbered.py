"""Line numbers of split text files, and exact slices by number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from presslake.sources.files import scan_lines

SPLIT = ["src_path", "src_block"]


def split_bases(lines: DataFrame) -> DataFrame:
    """One row per split of ``scan_lines``: how many lines of its file come before it, and how many it has.

    Splits are counted where they are read, with one partial row a split; the sums
    run over splits, not over lines.
    """
    counts = lines.groupBy(*SPLIT).agg(F.count("*").alias("n_lines"), F.min("src_row").alias("first_row"))
    before = Window.partitionBy("src_path").orderBy("src_block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("base", F.coalesce(F.sum("n_lines").over(before), F.lit(0)))


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """``lines`` (of ``scan_lines``) with ``line_no``, counted from 0 in each file, blank lines included.

    Rows of a split are numbered in the order in which they are read; the sums of the
    splits before are added by a join with the short table of splits.
    """
    bases = split_bases(lines).select(*SPLIT, "first_row", "base")
    joined = lines.join(bases, SPLIT)
    return joined.withColumn("line_no", F.col("base") + F.col("src_row") - F.col("first_row")).drop("base", "first_row")


def line_slice(spark: SparkSession, paths: str | Sequence[str], start: int, stop: int) -> DataFrame:
    """``src_path, line_no, value`` of the lines ``start <= line_no < stop`` of every file."""
    lines = scan_lines(spark, paths)
    bases = split_bases(lines).where((F.col("base") < stop) & (F.col("base") + F.col("n_lines") > start))
    joined = lines.join(bases.select(*SPLIT, "first_row", "base"), SPLIT)
    number = F.col("base") + F.col("src_row") - F.col("first_row")
    return joined.select("src_path", number.alias("line_no"), "value").where(F.col("line_no").between(start, stop - 1))
