"""Language identification by prediction by partial matching.

For each language a context tree over bytes holds how often a byte followed the
three, two, one or zero bytes before it. A byte that was never seen in a context
escapes to the next shorter one (escape method C: a context with ``n`` symbols,
``d`` of them different, escapes with probability ``d / (n + d)``); below order
zero all 256 bytes are equally likely. The statistics are frozen after fitting,
so the code length of a text is a sum over its four-byte windows and all
languages are scored in one pass over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import CHUNK_BYTES, flat_text, sample_condition, text_slices

ORDER = 3
SAMPLE_PER_LANGUAGE = 2000
PIECE = 1 << 19
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class ByteTable:
    """A fixed hash table from windows (up to 32 bits) to rows of bit costs."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, EMPTY)
        self.at = np.zeros(len(self.keys), np.int32)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots] == EMPTY
            _, first = np.unique(slots[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.keys[slots[placed]] = keys[left[placed]]
            self.at[slots[placed]] = left[placed]
            stay = np.ones(len(left), bool)
            stay[placed] = False
            left, slots = left[stay], slots[stay] + 1
            if len(slots) and slots.max() >= len(self.keys):
                grow = len(self.keys)
                self.keys = np.concatenate([self.keys, np.full(grow, EMPTY)])
                self.at = np.concatenate([self.at, np.zeros(grow, np.int32)])
        self.rows = rows.astype(np.float32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row number of each key, or -1."""
        slots = self._slot(keys)
        held = self.keys[slots]
        found = np.where(held == keys, self.at[slots], -1)
        todo = np.flatnonzero((held != keys) & (held != EMPTY))
        while len(todo):
            slots[todo] += 1
            held = self.keys[slots[todo]]
            hit = held == keys[todo]
            found[todo[hit]] = self.at[slots[todo[hit]]]
            todo = todo[~hit & (held != EMPTY)]
        return found


@dataclass
class PPM:
    """Frozen statistics: bit costs of seen windows and of escapes, by order."""

    languages: list[str]
    costs: list[ByteTable]
    escapes: list[ByteTable]

    def bits(self, windows: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each window, in each language."""
        out = np.zeros((len(windows), len(self.languages)), np.float32)
        todo = np.arange(len(windows))
        for order in range(ORDER, -1, -1):
            keys = windows[todo] & np.uint64((1 << (8 * order + 8)) - 1)
            at = self.costs[order].find(keys)
            seen = at >= 0
            out[todo[seen]] += self.costs[order].rows[at[seen]]
            todo, keys = todo[~seen], keys[~seen]
            if not len(todo):
                return out
            at = self.escapes[order].find(keys >> np.uint64(8))
            known = at >= 0
            out[todo[known]] += self.escapes[order].rows[at[known]]
        out[todo] += 8
        return out


def windows_of(data: np.ndarray, offsets: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Each byte of ``data[begin:end]`` below the three bytes before it; zeros before a row."""
    out = data[begin:end].astype(np.uint64)
    for back in range(1, ORDER + 1):
        before = np.zeros(end - begin, np.uint64)
        skip = max(0, back - begin)
        before[skip:] = data[begin - back + skip : end - back]
        for step in range(back):
            edge = offsets[:-1] + step
            edge = edge[(edge >= begin) & (edge < end) & (edge < offsets[1:])]
            before[edge - begin] = 0
        out |= before << np.uint64(8 * back)
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        for lang in batch.column("lang").unique().to_pylist():
            rows = batch.filter(pc.equal(batch.column("lang"), lang))
            data, offsets = flat_text(rows.column("text"))
            windows, counts = np.unique(windows_of(data, offsets, 0, len(data)), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(windows)), pa.array(windows.astype(np.int64)), pa.array(counts)],
                names=["lang", "win", "n"],
            )


def fit_language_model(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> PPM:
    """Statistics of ``text`` by ``lang``.

    Fitted on a bounded sample: the ``per_language`` distinct texts of smallest
    hash in each language, each of them whole. Rows without text or language
    teach nothing.
    """
    hashed = rows.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("_h"))
    sample = hashed.where(sample_condition(hashed, "lang", per_language)).dropDuplicates(["lang", "_h"])
    counted = sample.select("lang", "text").mapInArrow(_counts, "lang string, win long, n long")
    table = counted.groupBy("lang", "win").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(table["lang"].to_pylist(), dtype=object)
    languages = sorted(set(langs.tolist()))
    which = np.searchsorted(np.array(languages, dtype=object), langs) if languages else np.zeros(0, int)
    return build_model(
        languages, which, table["win"].to_numpy().astype(np.uint64), table["n"].to_numpy().astype(np.float64)
    )


def build_model(languages: list[str], which: np.ndarray, windows: np.ndarray, n: np.ndarray) -> PPM:
    costs: list[ByteTable] = []
    escapes: list[ByteTable] = []
    lower_keys, lower = np.zeros(0, np.uint64), np.zeros((0, len(languages)))
    for order in range(ORDER + 1):
        keys, at = np.unique(windows & np.uint64((1 << (8 * order + 8)) - 1), return_inverse=True)
        counts = np.zeros((len(keys), len(languages)))
        np.add.at(counts, (at, which), n)
        contexts, context_at = np.unique(keys >> np.uint64(8), return_inverse=True)
        total = np.zeros((len(contexts), len(languages)))
        kinds = np.zeros_like(total)
        np.add.at(total, context_at, counts)
        np.add.at(kinds, context_at, counts > 0)
        whole = np.maximum(total + kinds, 1)
        escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / whole), 0.0)
        if order:
            below = lower[np.searchsorted(lower_keys, keys & np.uint64((1 << (8 * order)) - 1))]
        else:
            below = np.full(counts.shape, 8.0)
        seen = -np.log2(np.maximum(counts, 1) / whole[context_at])
        cost = np.where(counts > 0, seen, escape[context_at] + below)
        costs.append(ByteTable(keys, cost))
        escapes.append(ByteTable(contexts, escape))
        lower_keys, lower = keys, cost
    return PPM(languages, costs, escapes)


def code_lengths(model: PPM, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each row in each language; long rows are summed piece by piece."""
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    for begin in range(0, len(data), PIECE):
        end = min(begin + PIECE, len(data))
        bits = model.bits(windows_of(data, offsets, begin, end))
        rows = np.arange(
            np.searchsorted(offsets, begin, side="right") - 1, np.searchsorted(offsets, end, side="left")
        )
        rows = rows[offsets[rows] < offsets[rows + 1]]
        out[rows] += np.add.reduceat(bits, np.maximum(offsets[rows] - begin, 0), axis=0, dtype=np.float64)
    return out


def score_languages(docs: DataFrame, model: PPM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: ``doc_id, lang_pred, score, bits_per_byte``.

    ``lang_pred`` is the language of the shortest code (the first by name on a
    tie), ``und`` with score 0 if the text is null, has no letter, or no language
    was learnt. ``score`` is the posterior of the languages under equal priors
    with the code lengths scaled to at most 64 bytes, so that it stays graded for
    long texts. Repeated rows give repeated results; an empty table gives none.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # with its class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = cloudpickle.loads(broadcast.value)
        for batch in text_slices(batches, "text", CHUNK_BYTES):
            data, offsets = flat_text(batch.column("text"))
            bits = code_lengths(held, data, offsets)
            size = np.maximum(np.diff(offsets), 1)
            known = batch.column("has_letter").to_numpy(zero_copy_only=False)
            if held.languages:
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                gap = (bits - least[:, None]) * (np.minimum(size, 64) / size)[:, None]
                score = np.where(known, 1 / np.exp2(-gap).sum(axis=1), 0.0)
                names = np.array(held.languages, dtype=object)[best]
            else:
                known = np.zeros(len(size), bool)
                names, score, least = np.full(len(size), "und", object), np.zeros(len(size)), 8.0 * size
            names = np.where(known, names, "und")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(least / size, pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score", "bits_per_byte"],
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")
