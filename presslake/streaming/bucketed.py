"""An article archive laid out by id, and incremental ingest that reads only what a batch touches.

The archive is a bucketed Parquet table. Its folders are ``batch=N/shelf=K``: the
shelf is one hash of the id, the bucket inside it another. A batch looks for its ids
on their shelves only (partition pruning), and since the files of a shelf are
bucketed and sorted by id, the look-up joins them where they lie: the archive is
never shuffled, however large it is.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from presslake.operators.dedup import first_wins
from presslake.operators.normalize import normalize
from presslake.operators.skew import distinct_keys
from presslake.plans.articles import with_dates
from presslake.schema import ARTICLE_COLUMNS, ARTICLE_DDL
from presslake.sinks.files import write_parquet
from presslake.streaming.ingest import LANDED, arriving_lines, for_each_batch

SHELVES = 16
BUCKETS = 8
COLUMNS = [*ARTICLE_COLUMNS, "date_parsed"]


@dataclass(frozen=True)
class Archive:
    """A bucketed archive at ``path``, known to the session as ``table``."""

    path: str
    table: str
    shelves: int
    buckets: int

    def shelf(self, article_id: str = "article_id") -> Column:
        return F.pmod(F.xxhash64(article_id), F.lit(self.shelves)).cast("int")


def open_archive(spark: SparkSession, path: str, shelves: int = SHELVES, buckets: int = BUCKETS) -> Archive:
    """The archive at ``path``, created if there is none.

    Its numbers of shelves and buckets are fixed when it is created and lie in the
    name of a marker file; later arguments do not change them. Batches that other
    sessions have written since are found.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = fs.globStatus(hadoop.Path(root, "_layout-*")) or ()
    if not len(marks):
        if fs.exists(root) and len(fs.listStatus(root)):
            raise ValueError(f"{path} holds data that is no bucketed archive")
        fs.mkdirs(root)
        fs.createNewFile(hadoop.Path(root, f"_layout-{shelves}-{buckets}"))
        marks = fs.globStatus(hadoop.Path(root, "_layout-*"))
    shelves, buckets = map(int, marks[0].getPath().getName().split("-")[1:])
    where = fs.makeQualified(root).toString()
    table = f"articles_{hashlib.sha256(where.encode()).hexdigest()[:16]}"
    location = where.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"""create table if not exists {table} ({ARTICLE_DDL}, date_parsed timestamp_ntz, batch long, shelf int)
            using parquet partitioned by (batch, shelf)
            clustered by (article_id) sorted by (article_id) into {buckets} buckets location '{location}'"""
    )
    spark.sql(f"msck repair table {table} sync partitions")
    return Archive(path, table, shelves, buckets)


def read_bucketed(spark: SparkSession, archive: Archive) -> DataFrame:
    """All articles, with the batch that brought them."""
    return _stored(spark, archive).select(*COLUMNS, "batch")


def _stored(spark: SparkSession, archive: Archive) -> DataFrame:
    spark.catalog.refreshTable(archive.table)  # a stream's batches run in a session of their own
    return spark.table(archive.table)


def known_ids(archive: Archive, ids: DataFrame, before: int) -> DataFrame:
    """Which of ``ids (article_id)`` batches below ``before`` hold; reads their shelves only.

    The driver gets the numbers of these shelves, at most ``archive.shelves``.
    """
    shelves = [r[0] for r in ids.select(archive.shelf().alias("shelf")).distinct().collect()]
    stored = _stored(ids.sparkSession, archive).where(F.col("shelf").isin(shelves) & (F.col("batch") < before))
    return stored.select("article_id").join(ids, "article_id", "left_semi")


def append_batch(archive: Archive, rows: DataFrame, batch_id: int) -> None:
    """Write one batch; a replay overwrites all that it wrote before.

    Rows are dealt out by bucket, so that a shelf gets one file a bucket.
    """
    spark = rows.sparkSession
    placed = rows.select(*COLUMNS, archive.shelf().alias("shelf")).repartition(archive.buckets, "article_id")
    spark.sql(
        f"insert overwrite table {archive.table} partition (batch = {int(batch_id)}, shelf) select * from {{placed}}",
        placed=placed,
    )


def ingest_bucketed(
    spark: SparkSession, raw_root: str, archive: Archive, checkpoint: str, max_files_per_batch: int = 1000
) -> None:
    """Convert the raw files that arrived since the last call, as ``ingest`` does, into a bucketed archive.

    The same line of an id stays, and a replayed batch owns its folder; what
    differs is what a batch costs: it reads the ids on the shelves of its own ids,
    in place, and writes new files only. Articles get their dates on the way in.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        ids = distinct_keys(normalize(batch, columns=["article_id"]), "article_id").select("article_id")
        rows = first_wins(normalize(batch), ["article_id"], LANDED)
        # Spark refuses to overwrite what the same job reads: the known ids of the batch are set down first.
        known = f"{archive.path}/_known"
        write_parquet(known_ids(archive, ids, batch_id), known, mode="overwrite")
        seen = batch.sparkSession.read.schema("article_id string").parquet(known)
        fresh = rows.join(seen, "article_id", "left_anti")
        append_batch(archive, with_dates(fresh.select(*ARTICLE_COLUMNS)), batch_id)

    for_each_batch(arriving_lines(spark, raw_root, max_files_per_batch), land, checkpoint)
