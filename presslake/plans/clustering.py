"""Clustering inside a dataset, so that row-group statistics prune on several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from presslake.sinks.files import write_parquet

BITS = 16  # of each column


def interleaved(columns: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of several whole numbers (0 to ``2**bits - 1``) in turn, the first column's first.

    Sorted by it, rows that are near in all columns are near each other. Columns times
    bits must stay below 64; a NULL counts as 0.
    """
    if not 0 < len(columns) * bits < 64:
        raise ValueError("too many bits for a long")
    terms = []
    for place, column in enumerate(columns):
        value = F.coalesce(column.cast("long"), F.lit(0))
        for bit in range(bits):
            to = bit * len(columns) + len(columns) - 1 - place
            terms.append(F.shiftleft(F.shiftright(value, bit).bitwiseAND(F.lit(1)), to))
    return reduce(lambda a, b: a.bitwiseOR(b), terms)


def hashed(column: str, bits: int = BITS) -> Column:
    """A whole number of ``bits`` bits from any column; equal values get equal numbers."""
    return F.pmod(F.xxhash64(column), F.lit(1 << bits))


def scaled(column: Column, low: Column, high: Column, bits: int = BITS) -> Column:
    """``low`` to ``high`` spread over all numbers of ``bits`` bits, in order."""
    share = (column - low) / F.greatest(high - low, F.lit(1))
    return F.least(F.floor(share * (1 << bits)), F.lit((1 << bits) - 1))


def write_clustered(
    articles: DataFrame, target: str, n_files: int, row_group_rows: int, ts: str = "date_parsed"
) -> None:
    """Write ``articles`` clustered by publishing time, category and id.

    A filter on any one of them then skips most row groups, without a folder for
    every value. Times are spread over the range the data has, which costs one pass
    over a single column; rows are sorted by range, so a category of any size is
    split over files.
    """
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    low, high = articles.agg(F.min(seconds), F.max(seconds)).first()
    when = scaled(seconds, F.lit(low or 0), F.lit(high or 0))
    key = interleaved([when, hashed("category"), hashed("article_id")])
    placed = articles.withColumn("_z", key).repartitionByRange(n_files, "_z", "article_id").sortWithinPartitions("_z", "article_id")
    write_parquet(placed.drop("_z"), target, row_group_rows=row_group_rows)
