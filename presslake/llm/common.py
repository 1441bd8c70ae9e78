"""Helpers of the training-data operators.

Text travels between Spark and numpy as Arrow string columns; ``flat_text``
views such a column as one byte array with row offsets, without a Python object
per row.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

import presslake

# Python workers get the helpers with the task; executors need no install.
cloudpickle.register_pickle_by_value(presslake)

CHUNK_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """``make()``, kept in this Python process between tasks."""
    held = sys.modules.setdefault("_presslake_worker", types.ModuleType("_presslake_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` has about ``limit`` bytes each; a longer text comes with the rows up to the next mark."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(flat_text(batch.column(column))[1])
        block = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(count: int, base: int = _MULTIPLIER) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for ``i < count``; ``base`` is odd."""

    def table(factor: int) -> np.ndarray:
        out = np.ones(max(count, 1), np.uint64)
        done = 1
        while done < len(out):
            step = np.uint64(pow(factor, done, 1 << 64))
            part = out[: min(done, len(out) - done)]
            out[done : done + len(part)] = part * step
            done *= 2
        return out

    def build() -> tuple[np.ndarray, np.ndarray]:
        return table(base), table(pow(base, -1, 1 << 64))

    size = 1 << max(count - 1, 1).bit_length()
    if size > 2 * CHUNK_BYTES:  # for one huge text; not kept
        return build()
    count, wanted = size, count
    forward, backward = worker_cache(f"powers-{base}-{size}", build)
    return forward[:wanted], backward[:wanted]


def prefix_hashes(values: np.ndarray, base: int = _MULTIPLIER) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i`` modulo 2**64, with a leading zero."""
    out = np.zeros(len(values) + 1, np.uint64)
    forward, _ = powers(len(values) + 1, base)
    np.cumsum(values.astype(np.uint64) * forward[: len(values)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _MULTIPLIER) -> np.ndarray:
    """Position-free hashes of the spans ``[start, end)`` from their prefix sums."""
    _, backward = powers(len(prefix), base)
    return (prefix[end] - prefix[start]) * backward[start]


# ASCII letters are lower-cased; digits, letters and all bytes from 0x80 on make words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def hashed_words(data: np.ndarray, offsets: np.ndarray, parts: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the rows, in order, and the words' row offsets.

    With ``parts`` the hashes are a matrix: below those of the words are those of
    their first ``n`` bytes, or last ``-n`` where ``n`` is negative; of a shorter
    word, those of the whole word.
    """
    low = LOWER[data]
    word = IS_WORD[low]
    first, last = word.copy(), word.copy()
    if len(word):
        edge = offsets[(offsets > 0) & (offsets < len(word))]
        first[1:] &= ~word[:-1]
        first[edge] = word[edge]
        last[:-1] &= ~word[1:]
        last[edge - 1] = word[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    prefix = prefix_hashes(low.astype(np.uint64) + np.uint64(1))
    found = [mix(span_hashes(prefix, start, end))]
    for n in parts:
        a, b = (start, np.minimum(start + n, end)) if n > 0 else (np.maximum(end + n, start), end)
        found.append(mix(span_hashes(prefix, a, b)))
    return np.stack(found) if parts else found[0], np.searchsorted(start, offsets)


def is_held_out(doc_id: Column) -> Column:
    """One quarter of the rows, told by the checksum of the id; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def sample_condition(hashed: DataFrame, key: str, per_key: int) -> Column:
    """Picks for each value of ``key`` the rows with the ``per_key`` smallest distinct ``_h``.

    Only the narrow columns ``key`` and ``_h`` are ranked, and Spark limits the
    ranks per task before the shuffle. The number of key values (languages,
    classes) must be small: each is one term of the condition.
    """
    distinct = hashed.select(key, "_h").where(F.col(key).isNotNull()).distinct()
    ranked = distinct.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_h")))
    limits = ranked.where(F.col("_n") <= per_key).groupBy(key).agg(F.max("_h").alias("_limit")).collect()
    chosen = F.lit(False)
    for row in limits:
        chosen = chosen | ((F.col(key) == F.lit(row[0])) & (F.col("_h") <= F.lit(row["_limit"])))
    return chosen
