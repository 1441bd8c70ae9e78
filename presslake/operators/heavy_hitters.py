"""The most frequent tags without moving the rare ones.

Each task keeps a summary of bounded size (Misra-Gries counters): what it counts of
a tag is too low by at most the task's error, and a tag it does not hold occurred no
more often than that. Summaries merge by adding counts and errors. Only tags that
can still be among the top are counted exactly, in a second pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from presslake.operators.analytics import TOP_TAGS

CAPACITY = 10_000


class Summary:
    """Misra-Gries counters: at most ``capacity`` values with lower bounds of their counts."""

    def __init__(self, capacity: int):
        self.capacity, self.counts, self.error = capacity, {}, 0

    def add(self, values: pa.Array) -> None:
        for pair in pc.value_counts(values.drop_null()).to_pylist():
            self.counts[pair["values"]] = self.counts.get(pair["values"], 0) + pair["counts"]
        self.shrink()

    def shrink(self) -> None:
        """Lower all counts by the largest one that has no room; what falls to zero goes."""
        if len(self.counts) > self.capacity:
            cut = sorted(self.counts.values(), reverse=True)[self.capacity]
            self.counts = {v: n - cut for v, n in self.counts.items() if n > cut}
            self.error += cut


def summarised(values: DataFrame, column: str, capacity: int) -> DataFrame:
    """``value, n, error`` of each task: its counters, and one row without value for its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity)
        for batch in batches:
            summary.add(batch.column(0))
        held = list(summary.counts.items())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([v for v, _ in held] + [None], pa.string()),
                pa.array([n for _, n in held] + [0], pa.int64()),
                pa.array([0] * len(held) + [summary.error], pa.int64()),
            ],
            names=["value", "n", "error"],
        )

    return values.select(F.col(column).cast("string")).mapInArrow(run, "value string, n long, error long")


def heavy_hitters(values: DataFrame, column: str, k: int, capacity: int = CAPACITY) -> DataFrame:
    """The ``k`` most frequent values of a text column with their exact ``frequency``; ties by value.

    Let E be the sum of all tasks' errors and L the k-th largest merged count. A value
    whose merged count is below L - E, or that no task holds while E < L, occurs less
    often than k others and is left out; all others are counted exactly. If E is not
    below L, the summaries are made again with four times the room: in the end they
    hold every value, and E is zero. Null is no value.
    """
    while True:
        parts = summarised(values, column, capacity)
        merged = parts.groupBy("value").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))
        # One pass gives the error (the row without value) and the k largest counts.
        top = merged.orderBy(F.col("value").isNotNull(), F.desc("n")).limit(k + 1).collect()
        error = sum(r["error"] for r in top if r["value"] is None)
        counts = [r["n"] for r in top if r["value"] is not None]
        least = counts[k - 1] if len(counts) >= k else 0
        if error < least or error == 0:
            break
        capacity *= 4
    chosen = merged.where(F.col("value").isNotNull() & (F.col("n") + error >= least))
    if error == 0:
        exact = chosen.select("value", F.col("n").alias("frequency"))
    else:
        # Every task holds at most ``capacity`` values, so this side is bounded by the tasks; the join is left to Spark.
        own = values.select(F.col(column).alias("value"))
        exact = own.join(chosen.select("value"), "value", "left_semi").groupBy("value").agg(F.count("*").alias("frequency"))
    return exact.orderBy(F.desc("frequency"), "value").limit(k)


def top_tags_sketch(articles: DataFrame, k: int = TOP_TAGS, capacity: int = CAPACITY) -> DataFrame:
    """The same rows as ``top_tags``; the long tail of tags is never shuffled."""
    tags = articles.select(F.explode("tags").alias("tag"))
    return heavy_hitters(tags, "tag", k, capacity).withColumnRenamed("value", "tag")
