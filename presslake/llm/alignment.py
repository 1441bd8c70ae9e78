"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Both token sequences of a text cover the same bytes, so each is a sorted list of
byte ends. Merging the two lists cuts the text into overlaps, each inside one A
and one B token; an overlap that ends both closes a group. The merge of a whole
batch of texts is divided along diagonals of the merge path: binary searches find
for each diagonal how many A and B ends lie before it, which gives pieces of equal
work that are merged independently of each other, wherever texts begin and end.
Groups that span pieces are stitched together afterwards.

Texts are encoded as runs of blanks with what follows. Neither vocabulary has a
token that goes on over such a border, so each run is encoded once for many
texts; texts for which that may not hold are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import text_slices, worker_cache
from presslake.llm.components import _written

PIECE = 4096  # ends that one piece merges
KEPT_BYTES = 48 << 20  # what the runs a worker keeps may take
RUN_BYTES = 200  # of one run, besides its text: entries of the tables and ids
ID_BITS = 32
LISTS = ("a_ids", "b_ids", "a_sizes", "b_sizes")
SLICE_TOKENS = 1 << 18
SLICE_BYTES = 1 << 18
JOINED = 200  # new runs that are encoded as one text

# Runs end where a blank follows something else; a blank after white space goes on.
_BORDER = re.compile(r"(?<=\S)(?= )")
_LONG_BLANK = re.compile(r"\s ")


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For each diagonal ``0, piece, 2 * piece, ...`` how many of ``a`` and ``b`` come before it.

    ``a`` and ``b`` are sorted; of equal values those of ``a`` come first. All
    diagonals are searched at once, in ``log(len)`` steps.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        before = np.zeros(len(diagonal), bool)
        before[open_] = a[middle[open_]] <= b[diagonal[open_] - 1 - middle[open_]]
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low, diagonal - low


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps of two segmentations of the same bytes: ``a index, b index, end`` of each, in order.

    ``a`` and ``b`` hold the ends of non-empty tokens and have the same last value.
    """
    if not len(a):
        return (np.zeros(0, np.int64),) * 3
    i, j = merge_path(a, b, piece)
    count = len(i) - 1
    sizes_a, sizes_b = np.diff(i), np.diff(j)
    # One row a piece: its own ends, marked with their side; only the last one is filled up.
    work = np.full((count, piece), np.iinfo(np.int64).max)
    place = np.repeat(np.arange(count) * piece - i[:-1], sizes_a) + np.arange(len(a))
    work.ravel()[place] = a * 2
    place = np.repeat(np.arange(count) * piece + sizes_a - j[:-1], sizes_b) + np.arange(len(b))
    work.ravel()[place] = b * 2 + 1
    work.sort(axis=1, kind="stable")  # merges the two runs of each row
    ends, of_b = work >> 1, (work & 1).astype(bool)
    filled = np.arange(piece) < (sizes_a + sizes_b)[:, None]
    # Tokens begun before each end, counted inside the piece and moved by what lies before it.
    at_b = np.cumsum(of_b & filled, axis=1) - of_b + j[:-1, None]
    at_a = np.cumsum(~of_b & filled, axis=1) - ~of_b + i[:-1, None]
    # An end that both sides share gives one overlap, at the A end; its B end comes next, maybe in the next piece.
    ends, at_a, at_b, of_b = (x.ravel()[: len(a) + len(b)] for x in (ends, at_a, at_b, of_b))
    first = np.ones(len(ends), bool)
    first[1:] = ends[1:] != ends[:-1]
    return at_a[first], at_b[first], ends[first]


def group_sizes(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many A and how many B tokens each group has: overlaps are stitched until both tokens end."""
    at_a, at_b, ends = overlaps(a, b, piece)
    both = (a[at_a] == ends) & (b[at_b] == ends)
    return np.diff(at_a[both], prepend=-1), np.diff(at_b[both], prepend=-1)


class Vocabulary:
    """Tokens of one side as bytes, and how a run of text is encoded."""

    def __init__(self, tokens: dict[int, bytes]):
        self.size = max(tokens, default=-1) + 1
        self.bytes = [tokens.get(i, b"") for i in range(self.size)]
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)

    def gives(self, ids: np.ndarray, data: bytes) -> bool:
        """Whether ``ids`` are made of whole tokens and give the bytes ``data``."""
        return bool(self.lengths[ids].all()) and b"".join(map(self.bytes.__getitem__, ids.tolist())) == data

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, laid end to end, and their number for each."""
        ids = self.encode(texts)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteLevel(Vocabulary):
    """A byte-level BPE of the ``tokenizers`` library; special tokens in a text are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        stands, special = byte_alphabet(), self.tokenizer.get_added_tokens_decoder()
        names = ((i, self.tokenizer.id_to_token(i)) for i in range(self.tokenizer.get_vocab_size()))
        super().__init__({i: bytes(map(stands.__getitem__, name)) for i, name in names if i not in special})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Vocabulary):
    """A ``sentencepiece`` model; it puts the blank in front of a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                tokens[i] = bytes([int(piece[3:5], 16)])
            elif not (self.model.is_control(i) or self.model.is_unknown(i)):
                tokens[i] = piece.replace("▁", " ").encode("utf-8")
        # A blank inside a token would let it go on over the border of two runs.
        self.runs = all(b" " not in t.lstrip(b" ") for t in tokens.values())
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t.removeprefix(" ") for t in texts], num_threads=1)


def _size(runs) -> int:
    return sum(map(len, runs)) + RUN_BYTES * len(runs)


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of all spans, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


def text_runs(text: str) -> list[str]:
    """Runs of ``" " + text``, each without the blank it begins with."""
    if _LONG_BLANK.search(text) or text[0] == " ":
        return [run[1:] for run in _BORDER.split(" " + text)]
    return text.split(" ")


class Aligner:
    """Both vocabularies and the runs a worker has encoded, within ``KEPT_BYTES``."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.width = 2 if max(self.a.size, self.b.size) <= 1 << 16 else 4
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.sound = np.zeros(0, bool)
        self.hits = np.zeros(0, np.int32)  # batches that held a run; halved whenever room is made

    def _make_room(self) -> None:
        """Keep the runs of several batches, as far as they take half the room; most runs are never seen again."""
        names = list(self.known)
        order = np.argsort(-self.hits, kind="stable")
        order = order[: int((self.hits > 1).sum())]
        sizes = np.fromiter(map(len, names), np.int64, len(names))[order] + RUN_BYTES
        stay = np.sort(order[: int(np.searchsorted(np.cumsum(sizes), KEPT_BYTES // 2, side="right"))])
        for side in (0, 1):
            begin, size = self.ends[side][stay], np.diff(self.ends[side])[stay]
            self.flat[side] = self.flat[side][_spans(begin, size)]
            self.ends[side] = np.concatenate([[0], np.cumsum(size)])
        self.sound, self.hits = self.sound[stay], self.hits[stay] // 2
        names = [names[i] for i in stay.tolist()]
        self.known, self.held = dict(zip(names, range(len(names)))), _size(names)

    def _learn(self, runs: list[str]) -> None:
        """Encode new runs, many in one text; those that may not be followed by another one alone."""
        runs.sort(key=lambda run: run[-1:].isspace() or not run)
        alone = next((i for i, run in enumerate(runs) if run[-1:].isspace() or not run), len(runs))
        flats, counts, sound = ([], []), ([], []), []
        for begin in [*range(0, alone, JOINED), *range(alone, len(runs))]:
            part = runs[begin : min(begin + JOINED, alone)] if begin < alone else [runs[begin]]
            coded = [self._joined(side, part) for side in (self.a, self.b)]
            if any(c is None for c in coded):
                data = [f" {run}" for run in part]
                coded = [side.coded(data) for side in (self.a, self.b)]
                ends = [np.concatenate([[0], np.cumsum(n)]).tolist() for _, n in coded]
                sound += [
                    all(s.gives(ids[e[i] : e[i + 1]], run.encode("utf-8")) for s, (ids, _), e in zip((self.a, self.b), coded, ends))
                    for i, run in enumerate(data)
                ]
            else:
                sound += [True] * len(part)
            for side, (ids, n) in enumerate(coded):
                flats[side].append(ids)
                counts[side].append(n)
        self.held += _size(runs)
        self.known.update(zip(runs, range(len(self.known), len(self.known) + len(runs))))
        self.sound = np.concatenate([self.sound, np.array(sound, bool)])
        self.hits = np.concatenate([self.hits, np.zeros(len(runs), np.int32)])
        for side in (0, 1):
            self.flat[side] = np.concatenate([self.flat[side], *flats[side]])
            new = np.cumsum(np.concatenate(counts[side])) + self.ends[side][-1]
            self.ends[side] = np.concatenate([self.ends[side], new])

    @staticmethod
    def _joined(side: Vocabulary, runs: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Runs encoded as one text; None unless its tokens give it back and end where the runs do."""
        text = " " + " ".join(runs)
        ids, _ = side.coded([text])
        if not side.gives(ids, text.encode("utf-8")):
            return None
        ends = np.cumsum(side.lengths[ids])
        borders = np.cumsum([1 + (len(run) if run.isascii() else len(run.encode("utf-8"))) for run in runs])
        last = np.searchsorted(ends, borders)
        if not (ends[last] == borders).all():
            return None
        return ids, np.diff(last, prepend=-1)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and, of each text, their number, for both sides; texts that do not come out as they were have none."""
        cut = text_runs if self.b.runs else lambda text: [text]
        runs = [cut(t) if t else [] for t in texts]
        every = list(chain.from_iterable(runs))
        new = set(every).difference(self.known)
        if self.held + _size(new) > KEPT_BYTES:
            self._make_room()
            new = set(every).difference(self.known)
            if self.held + _size(new) > KEPT_BYTES:
                self.forget()
                new = set(every)
        if new:
            self._learn(list(new))
        at = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        self.hits[np.unique(at)] += 1
        owner = np.repeat(np.arange(len(texts)), [len(own) for own in runs])
        unsound = np.unique(owner[~self.sound[at]])
        keep = ~np.isin(owner, unsound)
        at, owner = at[keep], owner[keep]
        ids, counts = [], []
        for side in (0, 1):
            begin, size = self.ends[side][at], np.diff(self.ends[side])[at]
            ids.append(self.flat[side][_spans(begin, size)])
            counts.append(np.bincount(owner, size, len(texts)).astype(np.int64))
        for row in unsound.tolist():  # settled on the whole text, as the definition has it
            text = " " + texts[row]
            whole = [side.coded([text])[0] for side in (self.a, self.b)]
            if all(side.gives(flat, text.encode("utf-8")) for side, flat in zip((self.a, self.b), whole)):
                for side, flat in enumerate(whole):
                    here = int(counts[side][:row].sum())
                    ids[side] = np.concatenate([ids[side][:here], flat, ids[side][here:]])
                    counts[side][row] = len(flat)
        return ids, counts

    def align(self, texts: list[str | None], piece: int = PIECE):
        """``ids, counts, sizes, groups``: as ``encode``, then tokens a group for both sides, and groups a text."""
        ids, counts = self.encode(texts)
        ends = [np.cumsum(s.lengths[x]) for s, x in zip((self.a, self.b), ids)]
        sizes = group_sizes(*ends, piece)  # texts end on both sides, so groups never span them
        last = np.concatenate([[0], np.cumsum(sizes[0])])
        groups = np.diff(np.searchsorted(last, np.concatenate([[0], np.cumsum(counts[0])])))
        return ids, counts, sizes, groups


def _aligner(path_a: str, path_b: str) -> Aligner:
    return worker_cache(f"align-{path_a}-{path_b}", lambda: Aligner(path_a, path_b))


def _lists(flat: np.ndarray, counts: np.ndarray, width: int = 4) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def _packed(flat: np.ndarray, counts: np.ndarray, width: int = 4) -> pa.Array:
    """The numbers of each row as little-endian unsigned integers of ``width`` bytes."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * width
    cells = [None, pa.py_buffer(ends), pa.py_buffer(flat.astype(f"<u{width}"))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), cells).cast(pa.binary())


def _aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str, text: str, piece: int, packed: bool) -> DataFrame:
    """``align_tokens``; packed, numbers are bytes, which Spark moves and stores without touching each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        build, width = (_packed, aligner.width) if packed else (_lists, 4)
        for batch in text_slices(batches, "text", SLICE_BYTES):
            ids, counts, sizes, groups = aligner.align(batch.column("text").to_pylist(), piece)
            cells = [build(x, n, width) for x, n in zip(ids, counts)] + [build(x, groups) for x in sizes]
            if packed:
                cells.append(pa.array(np.full(batch.num_rows, width), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cells], names=["doc_id", *LISTS, "width"][: len(cells) + 1])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} {'binary' if packed else 'array<int>'}" for c in LISTS)
    return rows.mapInArrow(run, f"doc_id {kind}, {lists}{', width int' * packed}")


def align_tokens(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", piece: int = PIECE
) -> DataFrame:
    """For each row ``doc_id, a_ids, b_ids, a_sizes, b_sizes``.

    Group ``k`` takes the next ``a_sizes[k]`` A tokens and the next ``b_sizes[k]``
    B tokens; it ends at the first byte offset where tokens of both sides end.
    A encodes a blank and the text, B the text (and adds the blank). Null and
    empty texts, and those whose tokens do not give the same bytes back, have
    empty lists. Both files must be readable on every worker. Repeated rows and
    null ids give rows of their own; an empty table gives none; other columns are
    ignored.
    """

    return _aligned(docs, path_a, path_b, doc_id, text, piece, packed=False)


def _token_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut batches so that their rows have about ``SLICE_TOKENS`` tokens each, or one row more."""
    for batch in batches:
        if batch.num_rows:
            tokens = sum(_flat(batch, c)[1] for c in ("a_ids", "b_ids"))
            cuts = np.flatnonzero(np.diff(np.cumsum(tokens) // SLICE_TOKENS)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                yield batch.slice(begin, end - begin)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column, laid end to end, and how many each row has."""
    column = batch.column(name)
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(), np.asarray(column.value_lengths()).astype(np.int64)
    width = batch.column("width")[0].as_py() if name.endswith("ids") else 4
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, f"<u{width}", (ends[-1] - ends[0]) // width, ends[0]) if data is not None and ends[-1] > ends[0] else []
    return np.asarray(flat, np.int64), np.diff(ends) // width


def _links(batch: pa.RecordBatch) -> np.ndarray:
    """A and B id of each link, in one number: the last tokens of each group."""
    (a, _), (b, _), (in_a, _), (in_b, _) = (_flat(batch, c) for c in LISTS)
    return (a[np.cumsum(in_a) - 1].astype(np.int64) << ID_BITS) | b[np.cumsum(in_b) - 1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link counts of a task; it holds one number for each distinct pair."""
    pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in _token_slices(batches):
        new, n = np.unique(_links(batch), return_counts=True)
        merged, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
        pairs, counts = merged, np.bincount(at, np.concatenate([counts, n])).astype(np.int64)
    low = pairs & ((1 << ID_BITS) - 1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(pairs >> ID_BITS, pa.int32()), pa.array(low, pa.int32()), pa.array(counts)], names=["a", "b", "n"]
    )


def link_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, n``: how many links hold each id pair.

    Two tokens that end together have one's bytes at the end of the other's, so
    there are no more pairs than suffixes of tokens: see ``pair_bound``.
    """
    return aligned.mapInArrow(_count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def pair_bound(path_a: str, path_b: str) -> int:
    """How many id pairs can ever be linked, from the vocabularies alone."""
    a, b = ([t for t in v.bytes if t] for v in (ByteLevel(path_a), Pieces(path_b)))  # special tokens have no bytes

    def matches(ends: list[bytes], of: list[bytes], proper: bool) -> int:
        held: dict[bytes, int] = {}
        for token in ends:
            held[token] = held.get(token, 0) + 1
        return sum(held.get(t[k:], 0) for t in of for k in range(int(proper), len(t)))

    return matches(a, b, False) + matches(b, a, True)


def link_statistics(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """For each row of ``align_tokens``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    A link is best if its pair's count is the highest of its B id. ``groups`` is
    the text ``a1,a2|b1;a3|b2,b3``, empty without tokens. The counts, bounded by
    the vocabularies, go to every worker.
    """
    table = counts.select("a", "b", "n").toArrow()
    pairs = (table["a"].to_numpy().astype(np.int64) << ID_BITS) | table["b"].to_numpy()
    order = np.argsort(pairs)
    pairs, n = pairs[order], table["n"].to_numpy()[order]
    low = pairs & ((1 << ID_BITS) - 1)
    highest = np.zeros(int(low.max(initial=-1)) + 1, np.int64)
    np.maximum.at(highest, low, n)
    shared = aligned.sparkSession.sparkContext.broadcast((pairs, n, n == highest[low]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in _token_slices(batches):
            (a, n_a), (b, n_b), (in_a, groups), (in_b, _) = (_flat(batch, c) for c in LISTS)
            at = np.searchsorted(pairs, _links(batch))
            owner = np.repeat(np.arange(batch.num_rows), groups)
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner, n[at])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(x, pa.int64()) for x in (n_a, n_b, groups, groups)],
                    pa.array(np.bincount(owner, best[at], batch.num_rows).astype(np.int64)),
                    pa.array(total),
                    pa.array(_spelled(a, b, n_a, n_b, in_a, in_b), pa.string()),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )

    kind = aligned.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    return aligned.mapInArrow(run, f"doc_id {kind}, {numbers}, groups string")


def _spelled(a, b, n_a, n_b, in_a, in_b) -> list[str]:
    """The groups of each row as text: ids in group order, each followed by its separator."""
    size = 1 << int(max(a.max(initial=0), b.max(initial=0))).bit_length()
    words = worker_cache(f"align-words-{size}", lambda: np.array([f"{i}{sign}" for sign in ",|;" for i in range(size)], object))
    order_a = np.arange(len(a)) + np.repeat(np.cumsum(in_b) - in_b, in_a)
    order_b = np.arange(len(b)) + np.repeat(np.cumsum(in_a), in_b)
    codes = np.zeros(len(a) + len(b), np.int64)
    codes[order_a], codes[order_b] = a, b
    codes[order_a[np.cumsum(in_a) - 1]] += size
    codes[order_b[np.cumsum(in_b) - 1]] += 2 * size
    parts = words[codes].tolist()
    ends = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    return ["".join(parts[x:y])[:-1] for x, y in zip(ends, ends[1:])]


def alignment_digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``link_statistics`` over all of ``docs``; the alignment is written once and read twice."""
    aligned = _written(_aligned(docs, path_a, path_b, "doc_id", "text", PIECE, packed=True), "aligned")
    return link_statistics(aligned, link_counts(aligned))
