"""Date enrichment of what is new in a stored dataset, and of nothing else."""

from __future__ import annotations

from pyspark.sql import SparkSession

from presslake.plans.articles import with_dates
from presslake.sinks.files import partition_columns, read_partitioned, write_parquet
from presslake.sources.files import existing, list_files

LEDGER_DDL = "file string"


def _files(spark: SparkSession, path: str) -> set[str]:
    """Data files below ``path``, relative to it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()
    return {name[len(root) + 1 :] for name in list_files(spark, [path])}


def enriched_files(spark: SparkSession, path: str) -> set[str]:
    """Files (relative to ``path``) that the ledger knows; some of them may be gone."""
    ledger = f"{path}/_enriched"
    if not existing(spark, [ledger]):
        return set()
    return {r.file for r in spark.read.schema(LEDGER_DDL).parquet(ledger).collect()}


def enrich_increment(spark: SparkSession, path: str) -> list[str]:
    """Add ``date_parsed`` to the partitions that hold files not seen before; returns their folders.

    Which files are new is told by their names and the ledger ``_enriched`` in the
    dataset, so neither rows nor footers of other partitions are read, and their
    files stay as they are. The touched partitions are replaced by dynamic partition
    overwrite, their new files being complete before the old ones go. A run that
    ends before it has noted its files is repeated by the next one, with the same
    result. The driver handles file names only, as it does to list a dataset.
    """
    levels = partition_columns(spark, path)
    if not levels:
        raise ValueError(f"{path} has no partition folders; use enrich_in_place")
    new = _files(spark, path) - enriched_files(spark, path)
    folders = sorted({name.rpartition("/")[0] for name in new})
    if not folders:
        return []
    rows = with_dates(read_partitioned(spark, path, folders))
    write_parquet(rows, path, mode="overwrite", partition_by=levels, dynamic=True)
    spark.catalog.refreshByPath(path)
    written = [(name,) for name in sorted(_files(spark, path)) if name.rpartition("/")[0] in set(folders)]
    spark.createDataFrame(written, LEDGER_DDL).coalesce(1).write.mode("append").parquet(f"{path}/_enriched")
    return folders
