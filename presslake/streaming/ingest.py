"""Incremental raw -> articles with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslake.operators.dedup import first_wins
from presslake.operators.normalize import normalize
from presslake.operators.skew import distinct_keys
from presslake.plans.articles import with_dates
from presslake.schema import ARTICLE_COLUMNS, ARTICLE_DDL
from presslake.sinks.files import read_partitioned, write_parquet
from presslake.sources.files import POSITION, existing

# Which line of an id came first: the file that landed first; of files of one
# instant the earlier run, then the position in the files.
LANDED = ["landed", "run_ts", *POSITION]


def read_archive(spark: SparkSession, target: str) -> DataFrame:
    """All articles ingested so far, with the batch that brought them.

    An enriched archive has ``date_parsed`` as well. A folder that holds data but
    no batch folders is no archive and an error.
    """
    if not existing(spark, [f"{target}/batch=*"]):
        if existing(spark, [f"{target}/[!_.]*"]):
            raise ValueError(f"{target} holds data without batch folders")
        return spark.createDataFrame([], f"{ARTICLE_DDL}, batch long")
    stored = read_partitioned(spark, target)
    extra = ["date_parsed"] if "date_parsed" in stored.columns else []
    return stored.select(*ARTICLE_COLUMNS, *extra, F.col("batch").cast("long").alias("batch"))


def arriving_lines(spark: SparkSession, raw_root: str, max_files_per_batch: int) -> DataFrame:
    """A stream of the lines of ``raw_root/*``, files in the order in which they landed."""
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", str(max_files_per_batch))
    return reader.load(f"{raw_root}/*").select(
        "value",
        F.col("_metadata.file_path").alias("src_path"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.col("_metadata.file_modification_time").alias("landed"),
    )


def for_each_batch(lines: DataFrame, land: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand ``land`` each batch of ``lines``, with the columns ``LANDED``, until nothing is left."""
    run_ts = F.regexp_extract("src_path", r"_([^_/]+)\.[^./_]+(?:/[^/]*)?$", 1)
    query = (
        lines.writeStream.foreachBatch(
            lambda batch, batch_id: land(
                batch.withColumn("src_row", F.monotonically_increasing_id()).withColumn("run_ts", run_ts), batch_id
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest(
    spark: SparkSession,
    raw_root: str,
    target: str,
    checkpoint: str,
    max_files_per_batch: int = 1000,
) -> None:
    """Convert the raw files that arrived since the last call, then return.

    Files are taken from ``raw_root/*`` in the order in which they landed, and the
    first line of an id wins: within a batch by ``LANDED``, and over batches since
    ids the archive already holds are dropped. The cut into batches of
    ``max_files_per_batch`` files therefore never changes which line stays. The
    anti join works on ids alone (a narrow reading of the lines), so the query
    keeps no state and no copy of the rows. Each batch owns one partition folder
    and overwrites it when it is replayed after a failure: every article ends up
    in the archive exactly once. An enriched archive gets enriched rows.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        archive = read_archive(session, target)
        earlier = archive.filter(F.col("batch") < batch_id).select("article_id")
        ids = distinct_keys(normalize(batch, columns=["article_id"]), "article_id")
        known = distinct_keys(earlier.join(ids, "article_id", "left_semi"), "article_id")
        rows = first_wins(normalize(batch), ["article_id"], LANDED)
        fresh = rows.join(known, "article_id", "left_anti").select(*ARTICLE_COLUMNS)
        if "date_parsed" in archive.columns:
            fresh = with_dates(fresh)
        write_parquet(fresh, f"{target}/batch={batch_id}", mode="overwrite")

    for_each_batch(arriving_lines(spark, raw_root, max_files_per_batch), land, checkpoint)
