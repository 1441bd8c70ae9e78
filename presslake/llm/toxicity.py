"""Toxicity: a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings: two of the whole word (two bucket tables, so
that a frequent word rarely shares both buckets with another) and one for each of
its beginnings and endings of a few lengths in bytes, so that the forms of a word
and words of one family share what they learn. Filters of several widths slide
over the words of a text, each filter keeps its largest response, and a logistic
layer turns the responses into a score. Only the positions that won the pooling
carry gradients, so a training step costs little more than a forward pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import flat_text, hashed_words, sample_condition, text_slices

BUCKETS = 1 << 17
PARTS = (3, 5, 7, -4, -6)
SLOTS = 2 + len(PARTS)
WIDTH = 8
FILTERS = 8
SIZES = (1, 2, 3)
SAMPLE_PER_CLASS = 4000
EPOCHS = 4
MOST_TURNS = 8  # of a text in an epoch
BATCH = 64
PIECE = 1 << 16


@dataclass
class TextCNN:
    """Parameters; ``kernel[s]`` has one ``WIDTH x FILTERS`` matrix for each word of size ``s``."""

    table: np.ndarray  # SLOTS x BUCKETS x WIDTH
    kernel: dict[int, np.ndarray]
    bias: np.ndarray  # of all filters
    weight: np.ndarray
    offset: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def embed(self, buckets: np.ndarray) -> np.ndarray:
        out = self.table[0][buckets[0]]
        for slot in range(1, SLOTS):
            out += self.table[slot][buckets[slot]]
        return out

    def responses(self, words: np.ndarray, ends: np.ndarray, starts: int) -> np.ndarray:
        """Filter responses at the first ``starts`` words; ``ends`` is each word's distance to its text's end."""
        out = np.full((starts, len(SIZES) * FILTERS), -np.inf, np.float32)
        for i, size in enumerate(SIZES):
            reach = min(starts, len(words) - size + 1)
            if reach <= 0:
                continue
            part = out[:reach, i * FILTERS : (i + 1) * FILTERS]
            part[:] = words[:reach] @ self.kernel[size][0]
            for j in range(1, size):
                part += words[j : j + reach] @ self.kernel[size][j]
            part += self.bias[i * FILTERS : (i + 1) * FILTERS]
            part[ends[:reach] < size] = -np.inf
        return out

    def pooled(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each text, at least zero; long texts go piece by piece."""
        out = np.zeros((len(offsets) - 1, len(SIZES) * FILTERS), np.float32)
        total = int(offsets[-1])
        overlap = max(SIZES) - 1
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for begin in range(0, total, PIECE):
            end = min(begin + PIECE, total)
            stop = min(end + overlap, total)
            found = self.responses(
                self.embed(buckets[:, begin:stop]),
                offsets[owner[begin:stop] + 1] - np.arange(begin, stop),
                end - begin,
            )
            rows, first = np.unique(owner[begin:end], return_index=True)
            out[rows] = np.maximum(out[rows], np.maximum.reduceat(found, first, axis=0))
        return out

    def logits(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.pooled(buckets, offsets).astype(np.float64) @ self.weight + self.offset

    def scores(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return _sigmoid(self.scale * self.logits(buckets, offsets) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def word_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word in each of the ``SLOTS`` tables, and the words' row offsets."""
    hashes, offsets = hashed_words(data, offsets, PARTS)
    mask = np.uint64(BUCKETS - 1)
    return np.concatenate([hashes & mask, (hashes[:1] >> np.uint64(32)) & mask]).astype(np.int32), offsets


def _initial(buckets: np.ndarray, offsets: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> TextCNN:
    """Small random parameters; the first embedding dimension starts at shrunk log odds of the buckets in ``rows``."""
    rng = np.random.default_rng(7)
    table = rng.normal(0, 0.02, (SLOTS, BUCKETS, WIDTH)).astype(np.float32)
    positive, negative = max(labels[rows].sum(), 1), max((1 - labels[rows]).sum(), 1)
    rare = 8 / min(positive, negative)
    for i in range(SLOTS):
        texts = np.zeros((2, BUCKETS))  # texts of each label that hold a bucket
        for row in rows:
            texts[int(labels[row]), np.unique(buckets[i, offsets[row] : offsets[row + 1]])] += 1
        table[i, :, 0] = np.log((texts[1] / positive + rare) / (texts[0] / negative + rare)) * 2 / SLOTS
    kernel = {
        s: (rng.normal(0, 0.2, (s, WIDTH, FILTERS)) + np.eye(WIDTH, FILTERS)[0][:, None] * 0.1).astype(np.float32)
        for s in SIZES
    }
    kernel[SIZES[0]][0, :, 0] = np.eye(WIDTH)[0]
    weight = rng.normal(0.1, 0.05, len(SIZES) * FILTERS)
    weight[0] = 1.0
    return TextCNN(table, kernel, np.zeros(len(weight), np.float32), weight, offset=-1.0)


def train_cnn(buckets: np.ndarray, offsets: np.ndarray, labels: np.ndarray, prior: float) -> TextCNN:
    """Fit on texts given as buckets; every fifth text calibrates the score.

    ``prior`` is the share of label 1 among all labelled rows, of which the given
    texts are a class-balanced sample.
    """
    if labels.min(initial=1) == labels.max(initial=0) or not len(labels):
        constant = _initial(buckets, offsets, labels, np.arange(len(labels)))
        constant.scale, constant.shift = 0.0, float(np.log((prior + 1e-6) / (1 - prior + 1e-6)))
        return constant
    order = np.random.default_rng(11).permutation(len(labels))
    check, learn = order[::5], np.setdiff1d(order, order[::5])
    model = _initial(buckets, offsets, labels, learn)  # reads them in place
    squares = {
        "table": np.full(model.table.shape, 0.1, np.float32),
        **{f"k{s}": np.full(model.kernel[s].shape, 0.1, np.float32) for s in SIZES},
        "bias": np.full(len(model.bias), 0.1),
        "weight": np.full(len(model.weight), 0.1),
        "offset": 0.1,
    }
    rng = np.random.default_rng(13)
    few = float(labels[learn].mean() <= 0.5)
    times = max(int(round((labels[learn] != few).sum() / max((labels[learn] == few).sum(), 1))), 1)
    learn = np.concatenate([learn, np.repeat(learn[labels[learn] == few], min(times, MOST_TURNS) - 1)])
    for epoch in range(EPOCHS):
        turn = rng.permutation(learn)
        for at in range(0, len(turn), BATCH):
            rows = turn[at : at + BATCH]
            _step(model, squares, *_subset(buckets, offsets, rows), labels[rows], 0.05 / (1 + epoch))
    _calibrate(model, model.logits(*_subset(buckets, offsets, check)), labels[check], prior)
    return model


def _subset(buckets: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(offsets[rows] - ends[:-1], sizes) + np.arange(ends[-1])
    return buckets[:, at], ends


def _step(model, squares, buckets, offsets, labels, rate) -> None:
    count = len(labels)
    words = model.embed(buckets)
    ends = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(words))
    found = model.responses(words, ends, len(words))
    best = np.zeros((count, found.shape[1]), np.int64)
    pooled = np.zeros((count, found.shape[1]))
    for i in range(count):
        part = found[offsets[i] : offsets[i + 1]]
        if len(part):
            best[i] = part.argmax(axis=0)
            pooled[i] = np.maximum(part[best[i], np.arange(part.shape[1])], 0)
            best[i] += offsets[i]
    error = (_sigmoid(pooled @ model.weight + model.offset) - labels) / count
    passed = np.where(pooled > 0, error[:, None] * model.weight, 0.0)  # gradient at each winning response
    grads = {"weight": pooled.T @ error + 1e-4 * model.weight, "offset": error.sum(), "bias": passed.sum(axis=0)}
    moved, pushes = [], []
    for i, size in enumerate(SIZES):
        own = slice(i * FILTERS, (i + 1) * FILTERS)
        row, col = np.nonzero(passed[:, own])
        push, at = passed[:, own][row, col], best[:, own][row, col]
        grad = np.zeros(model.kernel[size].shape)
        for j in range(size):
            np.add.at(grad[j].T, col, push[:, None] * words[at + j])
            moved.append(at + j)
            pushes.append(push[:, None] * model.kernel[size][j][:, col].T)
        grads[f"k{size}"] = grad
    if moved and sum(map(len, moved)):
        at, push = np.concatenate(moved), np.concatenate(pushes)
        for i in range(SLOTS):
            rows, where = np.unique(buckets[i][at], return_inverse=True)
            total = np.zeros((len(rows), WIDTH))
            np.add.at(total, where, push)
            squares["table"][i][rows] += total**2
            model.table[i][rows] -= rate * total / np.sqrt(squares["table"][i][rows])
    for name, grad in grads.items():
        squares[name] = squares[name] + grad**2
        change = rate * grad / np.sqrt(squares[name])
        if name[0] == "k":
            model.kernel[int(name[1:])] -= change.astype(np.float32)
        elif name == "bias":
            model.bias -= change.astype(np.float32)
        else:
            setattr(model, name, getattr(model, name) - change)


def _calibrate(model: TextCNN, logits: np.ndarray, labels: np.ndarray, prior: float) -> None:
    """Platt scaling on texts that were not trained on, weighted back to the share ``prior``."""
    positive = labels.mean()
    if not 0 < positive < 1:
        return
    weights = np.where(labels == 1, prior / positive, (1 - prior) / (1 - positive))
    target = np.where(labels == 1, 1 - 1 / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    features = np.stack([logits, np.ones_like(logits)], axis=1)
    solution = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(features @ solution)
        slope = features.T @ (weights * (p - target)) + 1e-6 * solution
        bend = (features * (weights * p * (1 - p))[:, None]).T @ features + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        solution -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
    if solution[0] > 0:
        model.scale, model.shift = float(solution[0]), float(solution[1])


def _bucketed(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``word_buckets`` of all texts, written slice by slice into one matrix.

    A word takes two bytes with the gap behind it, which bounds the columns; those
    that no word fills are never touched and take no memory.
    """
    most = sum((len(flat_text(c)[0]) + len(c)) // 2 + 1 for c in texts.chunks)
    buckets, offsets, done = np.empty((SLOTS, most), np.int32), [np.zeros(1, np.int64)], 0
    for part in text_slices((pa.RecordBatch.from_arrays([c], names=["text"]) for c in texts.chunks), "text"):
        found, ends = word_buckets(*flat_text(part.column("text")))
        buckets[:, done : done + found.shape[1]] = found
        offsets.append(ends[1:] + done)
        done += found.shape[1]
    return buckets[:, :done], np.concatenate(offsets)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> TextCNN:
    """Fit on ``docs (doc_id, text)`` and ``labels (doc_id, label)``.

    The classifier sees a bounded sample, the ``per_class`` distinct texts of
    smallest hash for each label, whole; the share of label 1 is counted over all
    labelled rows. Labels other than 0 and 1 and rows without text teach nothing;
    a repeated id has its largest label. Without rows of both labels every score
    is the share of label 1.
    """
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    docs = docs.where("text is not null").select("doc_id", "text")
    hashed = docs.select("doc_id", F.xxhash64("text").alias("_h")).join(known, "doc_id")
    prior = hashed.agg(F.avg("label")).first()[0]
    picked = hashed.where(sample_condition(hashed, "label", per_class)).dropDuplicates(["label", "_h"])
    picked = F.broadcast(picked.select("doc_id", "label", "_h"))  # 2 * per_class rows at most
    sample = docs.join(picked, "doc_id").where(F.xxhash64("text") == F.col("_h"))
    table = sample.select("label", "text").toArrow()  # texts take a fifth of their buckets on the way
    labels = table["label"].to_numpy().astype(np.float64)
    buckets, offsets = _bucketed(table["text"])
    del table
    return train_cnn(buckets, offsets, labels, 0.5 if prior is None else float(prior))


def score_toxicity(
    docs: DataFrame, model: TextCNN, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, score`` and the columns ``keep`` of each row; texts without words get the score of no response.

    The whole text is scored, whatever its length, and nothing but the text.
    Repeated rows give repeated results; an empty table gives none.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # with its class
    names = ["doc_id", *keep, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = cloudpickle.loads(broadcast.value)
        for batch in text_slices(batches, "_text"):
            score = pa.array(held.scores(*word_buckets(*flat_text(batch.column("_text")))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), score], names=names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text"]
    return rows.mapInArrow(run, ", ".join([*fields, "score double"]))


def language_thresholds(scored: DataFrame, bins: int = 200) -> DataFrame:
    """For each ``lang`` the threshold of best F1 over all rows with ``label`` and ``score``.

    Scores are counted in ``bins`` steps, so a language is a few hundred counts
    however many rows it has. Ties go to the larger threshold. A language without
    label 1 gets threshold 1.
    """
    step = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    counts = (
        scored.where("label in (0, 1) and lang is not null")
        .groupBy("lang", step.alias("bin"))
        .agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n"))
    )
    per_bin = F.collect_list(F.struct("bin", "hits", "n"))
    whole = counts.groupBy("lang").agg(F.sum("hits").alias("all_hits"), per_bin.alias("bins"))
    picked = whole.select(
        "lang",
        "all_hits",
        F.transform(
            "bins",
            lambda b: F.struct(
                b["bin"].alias("bin"),
                F.aggregate("bins", F.lit(0).cast("long"), lambda s, x: s + F.when(x["bin"] >= b["bin"], x["hits"]).otherwise(0)).alias("tp"),
                F.aggregate("bins", F.lit(0).cast("long"), lambda s, x: s + F.when(x["bin"] >= b["bin"], x["n"]).otherwise(0)).alias("flagged"),
            ),
        ).alias("cuts"),
    )
    best = F.array_max(
        F.transform(
            "cuts", lambda c: F.struct((2 * c["tp"] / (c["flagged"] + F.col("all_hits"))).alias("f1"), c["bin"].alias("bin"))
        )
    )
    threshold = F.when(F.col("all_hits") > 0, best["bin"] / F.lit(float(bins))).otherwise(1.0)
    return picked.select("lang", threshold.alias("threshold"))
