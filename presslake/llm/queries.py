"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from presslake.llm.alignment import alignment_digests
from presslake.llm.bpe import bpe_decode, bpe_encode
from presslake.llm.chat import format_chats, read_chats
from presslake.llm.common import is_held_out
from presslake.llm.components import _written
from presslake.llm.decontaminate import decontaminate
from presslake.llm.exact_dedup import exact_dedup
from presslake.llm.html_text import extract_text
from presslake.llm.language import fit_language_model, score_languages
from presslake.llm.near_dup import ngram_join
from presslake.llm.oracles import ORACLES
from presslake.llm.setsketch import near_duplicates
from presslake.llm.suffix_dedup import remove_repeats
from presslake.llm.tokens import read_documents, read_shards, write_shards
from presslake.llm.toxicity import fit_toxicity, language_thresholds, score_toxicity
from presslake.llm.whitening import whiten
from presslake.session import configure, scratch_dir

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = is_held_out(F.col("doc_id"))
    known = labels.where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    model = fit_toxicity(docs.where(~held_out), known)
    scored = _written(score_toxicity(docs, model, keep=("lang",)), "toxicity")
    thresholds = language_thresholds(scored.join(known, "doc_id"))
    flagged = F.col("score") >= F.coalesce("threshold", F.lit(0.3))
    return scored.join(F.broadcast(thresholds), "lang", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        flagged.alias("flagged_by_lang"),
    )


@query
def op2_html_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op3_bpe(spark, sf_dir):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe_encode(table(spark, sf_dir, "documents"), path, pattern)
    return bpe_decode(encoded, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return read_chats(format_chats(turns.unionByName(own), path, pattern), path, pattern)


@query
def op5_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query
def op7_decontaminate(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


@query
def op8_token_shards(spark, sf_dir):
    path = scratch_dir(spark, "token-shards")
    docs = table(spark, sf_dir, "documents")
    write_shards(docs, path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return read_documents(read_shards(spark, path))


@query
def op9_ngram_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~is_held_out(F.col("doc_id"))))
    scored = score_languages(docs, model)
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


@query
def op11_setsketch(spark, sf_dir):
    return near_duplicates(table(configure(spark), sf_dir, "documents"))


@query
def op12_token_alignment(spark, sf_dir):
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = alignment_digests(table(configure(spark), sf_dir, "documents"), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


@query
def op13_whitening(spark, sf_dir):
    found = whiten(table(configure(spark), sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
