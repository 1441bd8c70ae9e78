"""Exact duplicates: local combining, salted digest groups, then one winner.

Every stage groups by the digest *and* the whole normalised text, so equal
digests alone never make two texts equal. Spark combines inside each map task
(the local stage), merges the copies of a text in ``salts`` groups, so that a
text which holds a third of all rows is spread, and then combines the few salt
winners. Rows find their group again through narrow columns only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F


def normalised(text: Column) -> Column:
    """``text`` with A-Z lower-cased; null is empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """One row per distinct text: ``text_sha256, text_check, keep_id, group_size``.

    ``text_check`` is a second hash of the text; two texts with the same digest
    (none are known) would still be told apart by it.
    """
    body = normalised(F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), body.alias("body"), F.sha2(body, 256).alias("text_sha256")
    )
    salted = rows.groupBy(
        "text_sha256", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "body"
    ).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = salted.groupBy("text_sha256", "body").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    return groups.select("text_sha256", F.xxhash64("body").alias("text_check"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """For each row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z. The row with the
    largest id stays; a null id stays only if its whole group has none. Rows that
    repeat both id and text share one decision. Null and empty texts are one
    text. An empty table gives no rows; other columns are ignored.
    """
    body = normalised(F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.sha2(body, 256).alias("text_sha256"),
        F.xxhash64(body).alias("text_check"),
    )
    groups = exact_groups(docs, doc_id, text, salts)
    return rows.join(groups, ["text_sha256", "text_check"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
