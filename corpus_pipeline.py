"""From raw documents to token ids: five stages, each written and read again.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over everything the stage
before kept. The first four drop documents and return the columns they got; the
last returns ids. Rows without ``doc_id`` are never dropped by a comparison with
other rows. Rows that repeat id and text count once from the second stage on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from presslake.llm.bpe import bpe_encode
from presslake.llm.common import is_held_out
from presslake.llm.decontaminate import decontaminate, document_key
from presslake.llm.exact_dedup import exact_dedup
from presslake.llm.language import fit_language_model, score_languages
from presslake.llm.near_dup import ngram_join
from presslake.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A text is rejected if the best language codes it longer than raw bytes, by more than this.
SLACK_BITS = 64

RANKS = "byte_bpe_50k.tiktoken"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", document_key(F.col("doc_id"), F.col("text")))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in ``keys.doc_id``; ids are compared null-safely."""
    gone = keys.select(F.col("doc_id.doc_id").alias("gone_id"), F.col("doc_id.check").alias("gone_check")).distinct()
    same = (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("gone_check")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    return docs.join(gone, same, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those that no learnt language explains."""
    model = fit_language_model(docs.where(~is_held_out(F.col("doc_id"))))
    keyed = _keyed(docs).withColumn("size", F.octet_length("text"))
    scored = score_languages(keyed, model, "_key").join(
        keyed.select(F.col("_key.doc_id").alias("d"), F.col("_key.check").alias("c"), "size").distinct(),
        F.col("doc_id.doc_id").eqNullSafe(F.col("d")) & (F.col("doc_id.check") == F.col("c")),
    )
    too_long = F.col("bits_per_byte") > 8 + SLACK_BITS / F.greatest("size", F.lit(1))
    unknown = (F.col("lang_pred") == "und") | too_long if model.languages else F.lit(False)
    return _without(docs, scored.where(unknown))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of largest id of each group of equal texts."""
    keyed = _keyed(docs)
    left = _without(docs, exact_dedup(keyed, "_key").where(~F.col("kept")))
    repeated = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("_key").alias("doc_id"))
    if not repeated.limit(1).count():
        return left
    once = _without(left, repeated)
    return once.unionByName(left.exceptAll(once).dropDuplicates(["doc_id", "text"]))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id of each group of near duplicates."""
    keyed = _keyed(docs).withColumn("_key", F.when(F.col("doc_id").isNotNull(), F.col("_key")))
    classes = ngram_join(keyed, "_key")
    return _without(docs, classes.where(F.col("class_id") != F.col("doc_id")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, benchmark).where("contaminated")
    return _without(docs, found.select(F.struct("doc_id", "check").alias("doc_id")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of each document."""
    encoded = bpe_encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=False)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", tokens),
]

# Language ID and the language's model cannot be put in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
