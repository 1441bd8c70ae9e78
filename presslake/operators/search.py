"""Substring search that opens only files which can hold the text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import presslake
from presslake.sinks.files import write_parquet

# Python workers get the helper with the task; executors need no install.
cloudpickle.register_pickle_by_value(presslake)

GRAM = 3
CHUNK = 1 << 21


def grams_of(texts: list[bytes]) -> pa.Array:
    """All overlapping runs of ``GRAM`` characters inside the texts (UTF-8), each once."""
    decoded = [t.decode("utf-8", "replace") for t in texts]
    points = np.frombuffer("".join(decoded).encode("utf-32-le"), "<u4")
    starts = max(len(points) - GRAM + 1, 0)
    inside = np.ones(len(points) + 1, bool)  # a run that starts here ends in the same text
    ends = np.cumsum([len(t) for t in decoded], dtype=np.int64)
    for i in range(1, GRAM):
        inside[np.maximum(ends - i, 0)] = False
    found = np.zeros(0, np.int64)
    for begin in range(0, starts, CHUNK):
        stop = min(begin + CHUNK, starts)
        codes = np.zeros(stop - begin, np.int64)
        for i in range(GRAM):  # 21 bits a character
            codes |= points[begin + i : stop + i].astype(np.int64) << (21 * i)
        found = np.union1d(found, codes[inside[begin:stop]])
    parts = np.stack([(found >> (21 * i)) & 0x1FFFFF for i in range(GRAM)], axis=1)
    joined = parts.astype("<u4").tobytes().decode("utf-32-le")
    return pa.array([joined[i : i + GRAM] for i in range(0, len(joined), GRAM)], pa.string())


def _grams_by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of the texts of each file, each once a batch."""
    for batch in batches:
        files = batch.column("file").dictionary_encode()
        for number, file in enumerate(files.dictionary.to_pylist()):
            texts = batch.column("text").filter(pc.equal(files.indices, number)).drop_null()
            grams = grams_of(texts.cast(pa.large_binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.repeat(file, len(grams)), grams], names=["file", "gram"])


def write_content_index(spark: SparkSession, articles: str, target: str, column: str = "content") -> None:
    """Postings ``gram, files`` of a stored dataset: which files hold a run of three characters.

    Runs are found by numpy for many texts at once and combined in the tasks that read
    a file, so a posting moves once a task.
    Postings are sorted by run, and a look-up reads the row groups of its runs only.
    A file that is added later is indexed by calling this again with its folder and
    another ``target``; ``content_search`` takes several indexes.
    """
    rows = spark.read.parquet(articles).select(F.col("_metadata.file_path").alias("file"), F.col(column).alias("text"))
    grams = rows.mapInArrow(_grams_by_file, "file string, gram string").distinct()
    postings = grams.groupBy("gram").agg(F.collect_set("file").alias("files"))
    write_parquet(postings.repartitionByRange("gram").sortWithinPartitions("gram"), target)


def candidate_files(index: DataFrame, word: str) -> list[str] | None:
    """Files that hold every run of ``word``, the rarest run first; None if the word is too short to tell.

    The driver gets one list of files a run: names, as for any listing.
    """
    wanted = {word[i : i + GRAM] for i in range(len(word) - GRAM + 1)}
    if not wanted:
        return None
    found = index.where(F.col("gram").isin(*wanted)).groupBy("gram").agg(F.flatten(F.collect_list("files")).alias("files"))
    postings = {r.gram: set(r.files) for r in found.collect()}
    if len(postings) < len(wanted):
        return []
    files: set[str] | None = None
    for held in sorted(postings.values(), key=len):
        files = held if files is None else files & held
        if not files:
            break
    return sorted(files)


def content_search(spark: SparkSession, articles: str, index: DataFrame, word: str, column: str = "content") -> DataFrame:
    """The rows of a stored dataset whose text contains ``word``, character by character.

    The same rows as a scan of all files gives; files that lack a run of the word are
    not opened. An index older than the dataset misses the files it has not seen.
    """
    stored = spark.read.parquet(articles)
    files = candidate_files(index, word)
    if files is not None:
        stored = spark.read.schema(stored.schema).parquet(*files) if files else stored.limit(0)
    return stored.where(F.contains(F.col(column), F.lit(word)))
