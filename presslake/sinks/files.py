"""Outputs: typed Parquet, JSON lines, text lists, CSV with a byte-order mark."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BOM = "\ufeff"


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one output partition together, large ones split over several tasks."""
    if not partition_by:
        return df
    return df.hint("rebalance", *[F.col(name) for name in partition_by])


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    row_group_rows: int | None = None,
    dynamic: bool = False,
) -> None:
    """Snappy Parquet; row groups by size, or of ``row_group_rows`` rows at most.

    With ``partition_by`` the rows are first rebalanced by those columns: a
    partition gets few files, and adaptive execution splits one that holds a
    large share of the rows over several tasks. With ``dynamic`` an overwrite
    replaces only the partitions that ``df`` has rows for.
    """
    writer = _balanced(df, partition_by).write.mode(mode).option("compression", "snappy")
    if row_group_rows:
        writer = writer.option("parquet.block.row.count.limit", str(row_group_rows))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_jsonl(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """JSON lines, non-ASCII text as it is; partitions are balanced like Parquet's."""
    _balanced(df, partition_by).write.mode(mode).partitionBy(*partition_by).json(path)


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    """One string column as text lines; appends to the folder by default."""
    lines.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV part files, each with a header line that starts with a byte-order mark."""
    first, *rest = df.columns
    marked = df.withColumnRenamed(first, BOM + first)
    writer = marked.write.mode(mode).option("header", "true").option("escape", '"')
    # Spark would trim values on the way out.
    writer = writer.option("ignoreLeadingWhiteSpace", "false")
    writer.option("ignoreTrailingWhiteSpace", "false").csv(path)


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Reads back what ``write_csv`` wrote (quoted line breaks included).

    An empty field is NULL and a quoted empty field the empty string; they only
    differ to the reader if NULL has a mark of its own.
    """
    reader = spark.read.schema(ddl).option("header", "true").option("escape", '"')
    reader = reader.option("nullValue", "\u0000").option("emptyValue", "")
    return reader.option("multiLine", "true").option("enforceSchema", "true").csv(path)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``name=value`` folder levels of a stored dataset, outermost first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    while True:
        folders = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not folders:
            return names
        at = folders[0]
        names.append(at.getName().partition("=")[0])


def read_partitioned(spark: SparkSession, path: str, only: Sequence[str] = ()) -> DataFrame:
    """A stored dataset with all columns of all its files; folder values stay text, as written.

    ``only`` names the partition folders to read, relative to ``path``.
    """
    parts = [f"{path}/{folder}" for folder in only] or [path]
    reader = spark.read.option("basePath", path)
    merged = reader.option("mergeSchema", "true").parquet(*parts).schema
    folders = set(partition_columns(spark, path))
    fields = [T.StructField(f.name, T.StringType() if f.name in folders else f.dataType) for f in merged]
    return spark.read.option("basePath", path).schema(T.StructType(fields)).parquet(*parts)


def _restore(fs, target, hadoop) -> None:
    """Put back a dataset that a stopped rewrite had set aside."""
    if not fs.exists(target):
        aside = fs.globStatus(hadoop.Path(f"{target.toString()}.old-*"))
        if aside and len(aside) == 1:
            fs.rename(aside[0].getPath(), target)


def rewrite_in_place(
    spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame]
) -> None:
    """Replace a Parquet dataset by ``transform`` of itself; its partition folders stay.

    The result is written next to the dataset and swapped in once complete. On
    failure the dataset stays as it was and the partial result is removed. If the
    process ends between the two renames, the next rewrite puts the dataset back.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    _restore(fs, target, hadoop)
    stamp = uuid.uuid4().hex[:12]
    staged, previous = hadoop.Path(f"{path}.tmp-{stamp}"), hadoop.Path(f"{path}.old-{stamp}")
    try:
        folders = partition_columns(spark, path)
        write_parquet(transform(read_partitioned(spark, path)), staged.toString(), partition_by=folders)
    except Exception:
        fs.delete(staged, True)
        raise
    if not fs.rename(target, previous):
        fs.delete(staged, True)
        raise OSError(f"could not set {path} aside")
    if not fs.rename(staged, target):
        fs.rename(previous, target)
        fs.delete(staged, True)
        raise OSError(f"could not publish {path}")
    fs.delete(previous, True)
    spark.catalog.refreshByPath(path)
