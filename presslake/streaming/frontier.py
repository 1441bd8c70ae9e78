"""The request filter of a crawl that may stop and go on: no address is asked for twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from presslake.functions.urls import canonical_url, url_fingerprint
from presslake.sources.files import existing, urls_of_lines

REQUEST_DDL = "url string, fingerprint binary"


def start_requests(
    spark: SparkSession, found: str, target: str, checkpoint: str, max_files_per_batch: int = 1000
) -> StreamingQuery:
    """Start to work off the link lists that arrived in ``found/*`` since the last run.

    Links are JSON lines with a ``url``. The first spelling of an address is a
    request, in normal form; all later ones are dropped, in this run and in those
    to come. The fingerprints (32 bytes an address) are the state of the query: it
    lies in RocksDB on the executors' disks, in as many partitions as the session
    had when the checkpoint began, and its changes are saved with every batch. A
    run that was stopped, whether between batches or inside one, goes on where the
    last complete batch ended, and the target's log leaves out what a broken one
    has written.
    """
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", str(max_files_per_batch))
    links = urls_of_lines(reader.load(f"{found}/*"))
    requests = links.select(canonical_url("url").alias("url"), url_fingerprint("url").alias("fingerprint"))
    return (
        requests.dropDuplicates(["fingerprint"])
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def next_requests(
    spark: SparkSession, found: str, target: str, checkpoint: str, max_files_per_batch: int = 1000
) -> None:
    """Work off all link lists that have arrived, then return."""
    start_requests(spark, found, target, checkpoint, max_files_per_batch).awaitTermination()


def read_requests(spark: SparkSession, target: str) -> DataFrame:
    """``url, fingerprint`` of every request so far; none before the first run."""
    if not existing(spark, [f"{target}/_spark_metadata"]):
        return spark.createDataFrame([], REQUEST_DDL)
    return spark.read.schema(REQUEST_DDL).parquet(target)
