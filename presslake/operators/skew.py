"""Keeping joins on reduced keys open to adaptive skew handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEY_BUCKETS = 64


def key_bucket(key: Column | str) -> Column:
    """A second grouping column, a function of ``key``, for keys that will be joined.

    Adaptive execution splits a skewed join partition only where the join reads
    its shuffles directly. After ``groupBy(key)`` the join would reuse that
    shuffle through the aggregate, and a hot key of the other side would stay in
    one task. Grouped by key and bucket, the reduced keys are shuffled once more
    (they are few and short), and the hot side can be split.
    """
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct values of one column, for use as a join side."""
    return df.select(key, key_bucket(key).alias("bucket")).distinct().select(key)
