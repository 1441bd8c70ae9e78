"""Benchmark decontamination with a positional inverted index of the training text.

The test side is cut into phrases (windows of consecutive words). Corpus counts of
the test terms tell each phrase's rarest and second rarest term; phrases with a
term the corpus lacks are out. The index then stores the postings of those terms
only: document, position, and the few words around it. A phrase's two lists are
shifted by the terms' offsets and intersected, so that what remains agrees on the
start of the phrase, and the stored words confirm it exactly. Shifted starts that
differ by at most ``slop`` words are proximity matches.

All of it is DataFrame work: no Python runs on the executors.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from presslake.session import scratch_dir

WINDOW = 10
BROADCAST_ROWS = 200_000

# Fixed value: all ASCII but digits and lower-case letters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of ``text`` in order, A-Z lower-cased; null has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS_ANY_CASE), lambda w: w != ""))


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if it has few rows, counted first; otherwise it is joined by shuffling."""
    small = df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if small else df


def phrases_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item_id, phrase``: the distinct windows of each item; a shorter item is one window."""
    words = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    cut = words.where(F.size("words") > 0).withColumn("start", F.explode(starts))
    return cut.select("item_id", F.slice("words", F.col("start") + 1, F.lit(window)).alias("phrase")).distinct()


@dataclass
class PhraseIndex:
    """``phrases``: phrase, its length, rarest terms and offsets; ``postings``: term, document key, position, words around."""

    phrases: DataFrame
    postings: DataFrame
    window: int


def document_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart that share an id but not the text."""
    return F.struct(doc_id.alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("check"))


def build_index(docs: DataFrame, phrases: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> PhraseIndex:
    """Count the test terms over all documents, then store the postings of each phrase's two rarest.

    ``phrases`` has a column ``phrase``. The stored tables go below
    ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    words = words_of(F.col(text))
    distinct = phrases.select("phrase").distinct()
    terms = distinct.select(F.explode("phrase").alias("term")).distinct()
    counts = (
        docs.select(F.explode(words).alias("term"))
        .join(_bounded(terms), "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = distinct.select("phrase", F.posexplode("phrase").alias("offset", "term"))
    counted = places.join(counts, "term").groupBy("phrase").agg(
        F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("by_n")
    )
    whole = counted.where(F.size("by_n") == F.size("phrase"))  # the corpus has every term
    first = F.col("by_n")[0]
    others = F.filter("by_n", lambda x: x["term"] != F.col("by_n")[0]["term"])
    stored = scratch_dir(spark, "phrase-index")
    whole.select(
        "phrase",
        F.size("phrase").alias("length"),
        first["term"].alias("term"),
        first["offset"].alias("offset"),
        F.get(others, F.lit(0))["term"].alias("term2"),
        F.get(others, F.lit(0))["offset"].alias("offset2"),
    ).write.parquet(f"{stored}/phrases")
    chosen = spark.read.parquet(f"{stored}/phrases")
    wanted = chosen.select("term").union(chosen.select("term2")).where("term is not null").distinct()
    reach = window - 1
    rows = docs.select(document_key(F.col(doc_id), F.col(text)).alias("key"), words.alias("words"))
    tokens = rows.select("key", "words", F.posexplode("words").alias("position", "term"))
    lead = F.least("position", F.lit(reach))
    postings = tokens.join(_bounded(wanted), "term").select(
        "term",
        "key",
        "position",
        lead.alias("lead"),
        F.slice("words", F.col("position") - lead + 1, lead + window).alias("around"),
    )
    postings.write.parquet(f"{stored}/postings")
    return PhraseIndex(chosen, spark.read.parquet(f"{stored}/postings"), window)


def _lists(index: PhraseIndex, term: str, offset: str) -> DataFrame:
    """Postings of each phrase's ``term``, shifted to the start of the phrase."""
    phrases = index.phrases.select(
        "phrase", "length", F.col(term).alias("term"), F.col(offset).alias("shift"), F.col("term2").isNull().alias("alone")
    )
    joined = index.postings.join(_bounded(phrases.where("term is not null")), "term")
    return joined.withColumn("start", F.col("position") - F.col("shift"))


def exact_matches(index: PhraseIndex) -> DataFrame:
    """``key, start, length, phrase`` of every occurrence of every phrase."""
    # Never below 1 where the start is valid; Spark may evaluate the slice before that filter.
    begin = F.greatest(F.col("lead") - F.col("shift") + 1, F.lit(1))
    rarest = _lists(index, "term", "offset").where("start >= 0")
    rarest = rarest.withColumn("same", F.slice("around", begin, F.col("length")) == F.col("phrase"))
    columns = ("key", "start", "length", "phrase")
    second = _lists(index, "term2", "offset2").select("phrase", "key", "start")
    # Null-safe on the id; the check hash leads the shuffle key.
    both = rarest.where("not alone").select(*columns, "same").alias("a").join(
        second.alias("b"),
        (F.col("a.key.check") == F.col("b.key.check"))
        & F.col("a.key.doc_id").eqNullSafe(F.col("b.key.doc_id"))
        & (F.col("a.start") == F.col("b.start"))
        & (F.col("a.phrase") == F.col("b.phrase")),
        "left_semi",
    )
    return rarest.where("alone").select(*columns, "same").unionByName(both).where("same").select(*columns)


def proximity_matches(index: PhraseIndex, slop: int) -> DataFrame:
    """``key, phrase, start, distance``: the two rarest terms stand up to ``slop`` words off their places.

    Both lists are cut into stretches of ``slop + 1`` starts and meet in the same
    or a neighbouring stretch, so no document's lists are crossed as a whole.
    """
    stretch = F.floor(F.col("start") / (slop + 1))
    left = _lists(index, "term", "offset").select("key", "phrase", "start", stretch.alias("stretch"))
    right = _lists(index, "term2", "offset2").select(
        F.col("key").alias("key2"),
        F.col("phrase").alias("phrase2"),
        F.col("start").alias("start2"),
        F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch2"),
    )
    near = left.join(
        right,
        (F.col("key.check") == F.col("key2.check"))
        & F.col("key.doc_id").eqNullSafe(F.col("key2.doc_id"))
        & (F.col("phrase") == F.col("phrase2"))
        & (F.col("stretch") == F.col("stretch2"))
        & (F.abs(F.col("start") - F.col("start2")) <= slop),
    )
    return near.groupBy("key", "phrase", "start").agg(F.min(F.abs(F.col("start") - F.col("start2"))).alias("distance"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """For each row of ``docs``: ``doc_id, check, n_words, n_hit, n_items, items, contaminated``.

    A word is hit if it lies in an occurrence of a window of a benchmark item;
    ``items`` holds the ids (as strings, sorted) of the items with such windows.
    Null, empty and wordless texts have no words and no hits; items without words
    and an empty benchmark hit nothing. A null item id counts as an empty string.
    Rows that share id and text share a result, rows that share only the id do
    not (``check`` tells them apart).
    """
    phrases = phrases_of(benchmark, item_id, item_text, window)
    index = build_index(docs, phrases, doc_id, text, window)
    matches = exact_matches(index)
    stored = scratch_dir(docs.sparkSession, f"phrase-matches-{uuid.uuid4().hex[:6]}")
    matches.write.parquet(stored)
    matches = docs.sparkSession.read.parquet(stored)
    covered = matches.select("key", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
    hits = covered.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    found = matches.select("key", "phrase").distinct().join(phrases, "phrase")
    items = (
        found.select("key", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"))
        .distinct()
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    per_doc = hits.join(items, "key").select(F.col("key.doc_id").alias("hit_id"), F.col("key.check").alias("hit_check"), "n_hit", "items")
    key = document_key(F.col(doc_id), F.col(text))
    rows = docs.select(key.alias("key"), word_count(F.col(text)).cast("long").alias("n_words"))
    joined = rows.join(
        per_doc,
        (F.col("key.check") == F.col("hit_check")) & F.col("key.doc_id").eqNullSafe(F.col("hit_id")),
        "left",
    )
    return joined.select(
        F.col("key.doc_id").alias("doc_id"),
        F.col("key.check").alias("check"),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
