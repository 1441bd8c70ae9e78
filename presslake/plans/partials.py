"""Aggregates kept per batch: a batch brings its part, reports add parts up.

A part is a small table in ``batch=N``. A batch that runs again replaces its part, so
nothing is counted twice. Old parts can be folded into one base; readers take the
newest base and the parts after it, so a fold may stop anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslake.operators.analytics import heatmap, tag_counts
from presslake.sinks.files import write_parquet

HEATMAP_DDL = "weekday int, hour int, article_count long"
TAGS_DDL = "tag string, frequency long"


def put_part(part: DataFrame, path: str, batch: int) -> None:
    """The part of one batch; one that is there is replaced."""
    write_parquet(part, f"{path}/batch={int(batch):012d}", mode="overwrite")


def _folders(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete parts or bases, in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop.Path(f"{path}/{kind}=*/_SUCCESS")) or ()
    return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in found)


def _live(spark: SparkSession, path: str) -> list[str]:
    """Folders a report reads: the newest base, and the parts of later batches."""
    bases = _folders(spark, path, "base")
    last = bases[-1] if bases else -1
    own = [f"{path}/base={last:012d}"] if bases else []
    return own + [f"{path}/batch={n:012d}" for n in _folders(spark, path, "batch") if n > last]


def merged_parts(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """All parts added up: the last column of ``ddl`` is summed over the others."""
    folders = _live(spark, path)
    rows = spark.read.schema(ddl).parquet(*folders) if folders else spark.createDataFrame([], ddl)
    *keys, value = rows.columns
    return rows.groupBy(*keys).agg(F.sum(value).alias(value))


def fold_parts(spark: SparkSession, path: str, ddl: str) -> None:
    """Put all parts so far into one base, then remove what it holds.

    Batches up to the folded ones must not come again: they are settled, as the
    checkpoint of a stream settles all but its last batch. That last batch is left.
    """
    batches = _folders(spark, path, "batch")
    bases = _folders(spark, path, "base")
    done = [n for n in batches[:-1] if not bases or n > bases[-1]]
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if done:
        folders = ([f"{path}/base={bases[-1]:012d}"] if bases else []) + [f"{path}/batch={n:012d}" for n in done]
        rows = spark.read.schema(ddl).parquet(*folders)
        *keys, value = rows.columns
        write_parquet(rows.groupBy(*keys).agg(F.sum(value).alias(value)), f"{path}/base={done[-1]:012d}", mode="overwrite")
        bases.append(done[-1])
    for kind, numbers in (("base", bases[:-1]), ("batch", [n for n in batches if bases and n <= bases[-1]])):
        for n in numbers:
            fs.delete(hadoop.Path(f"{path}/{kind}={n:012d}"), True)


def put_heatmap(articles: DataFrame, path: str, batch: int) -> None:
    put_part(heatmap(articles), path, batch)


def merged_heatmap(spark: SparkSession, path: str) -> DataFrame:
    return merged_parts(spark, path, HEATMAP_DDL)


def put_tag_counts(articles: DataFrame, path: str, batch: int) -> None:
    put_part(tag_counts(articles), path, batch)


def merged_top_tags(spark: SparkSession, path: str, k: int) -> DataFrame:
    """``top_tags`` over all batches; ties by tag."""
    return merged_parts(spark, path, TAGS_DDL).orderBy(F.desc("frequency"), "tag").limit(k)
