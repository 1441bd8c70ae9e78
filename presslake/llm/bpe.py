"""Byte-level BPE as a tree reduction.

Encoding is a monoid: the encoding of a piece is the join of the encodings of its
halves, down to a few bytes that are merged directly. A join re-encodes a window of
tokens around the seam and widens it until the first and the last token of the
window come out as they were. The tokens outside are then final: a token sequence is the encoding of its
bytes exactly if each pair of neighbours is the encoding of the pair's bytes, and
every neighbouring pair now lies in the window or was a pair of one of the halves.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import text_slices, worker_cache

CACHED_PIECES = 400_000
SHORT_PIECE = 40
LEAF = 24
NO_RANK = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeBPE:
    """Encodes pieces of text by halves; ``ranks`` must hold all single bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.split = regex.compile(pattern).findall
        # The same split for ASCII text, where the classes are ranges.
        blank = "\t\n\x0b\x0c\r "  # what is white space to re is more
        ascii_pattern = pattern.replace(r"\s\p{L}\p{N}", f"{blank}A-Za-z0-9").replace(r"\p{L}", "[A-Za-z]")
        ascii_pattern = ascii_pattern.replace(r"\s", f"[{blank}]").replace(r"\S", f"[^{blank}]")
        self.split_ascii = re.compile(ascii_pattern.replace(r"\p{N}", "[0-9]")).findall
        spelled = [self.tokens.get(rank) for rank in range(max(self.tokens) + 1)]
        self.spelled = pa.array(spelled, pa.large_binary())
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.seams: dict[tuple[int, int], tuple[int, ...]] = {}

    def forget(self) -> None:
        """Drop what was learnt from texts."""
        self.pieces.clear()
        self.parts.clear()
        self.seams.clear()

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``; each match of the pattern is encoded for itself."""
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def packed(self, text: str) -> bytes:
        """Ids of ``text`` as 32-bit integers."""
        pieces = self.split_ascii(text) if text.isascii() else self.split(text)
        known = self.pieces
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) > CACHED_PIECES:
            known.clear()
        new = set(pieces).difference(known)
        for piece in new:
            known[piece] = array("i", self.encode_piece(piece.encode("utf-8"))).tobytes()
        ids = b"".join(map(known.__getitem__, pieces))
        for piece in new:
            if len(piece) > SHORT_PIECE:
                del known[piece]
        return ids

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Encode the halves and join them; halves break at the largest power of two, down to ``LEAF`` bytes."""
        if len(piece) <= LEAF:
            return self.merge_short(piece)
        rank = self.ranks.get(piece)
        if rank is not None:
            return (rank,)
        half = 1 << ((len(piece) - 1).bit_length() - 1)
        return self.join(self._part(piece[:half]), self._part(piece[half:]))

    def _part(self, piece: bytes) -> tuple[int, ...]:
        """``encode_piece``; a leaf of a long piece is remembered, since long pieces tend to repeat themselves."""
        if len(piece) > LEAF:
            return self.encode_piece(piece)
        ids = self.parts.get(piece)
        if ids is None:
            if len(self.parts) > CACHED_PIECES // 4:
                self.parts.clear()
            ids = self.parts[piece] = self.merge_short(piece)
        return ids

    def merge_short(self, data: bytes) -> tuple[int, ...]:
        """What ``merge`` gives, for few bytes: the lowest rank is looked for in a list."""
        ranks = self.ranks
        rank = ranks.get(data)
        if rank is not None:
            return (rank,)
        get = ranks.get
        cuts = list(range(len(data) + 1))
        pairs = [get(data[i : i + 2], NO_RANK) for i in range(len(data) - 1)]  # of the parts at cuts i and i + 1
        while pairs:
            best = min(pairs)
            if best == NO_RANK:
                break
            i = pairs.index(best)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(data[cuts[i] : cuts[i + 2]], NO_RANK)
            if i:
                pairs[i - 1] = get(data[cuts[i - 1] : cuts[i + 1]], NO_RANK)
        return tuple([ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])])

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of both byte strings together."""
        a, b = 1, 1
        while True:
            window = self._window(left[-a:], right[:b])
            left_holds = a >= len(left) or window[0] == left[-a]
            right_holds = b >= len(right) or window[-1] == right[b - 1]
            if left_holds and right_holds:
                return left[: max(len(left) - a, 0)] + window + right[b:]
            a = a if left_holds else 2 * a
            b = b if right_holds else 2 * b

    def _window(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if len(left) == 1 == len(right):
            pair = (left[0], right[0])
            seam = self.seams.get(pair)
            if seam is None:
                if len(self.seams) > CACHED_PIECES:
                    self.seams.clear()
                seam = self.seams[pair] = self.merge(self.tokens[pair[0]] + self.tokens[pair[1]])
            return seam
        return self.merge(b"".join([self.tokens[t] for t in left + right]))

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Merge the neighbours of lowest rank, leftmost first, until none has a rank."""
        ranks = self.ranks
        rank = ranks.get(data)
        if rank is not None:
            return (rank,)
        count = len(data)
        end = list(range(1, count + 1))  # where the part that starts here ends
        before = list(range(-1, count - 1))
        queue = [(r, i) for i in range(count - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(queue)
        alive = [True] * count
        while queue:
            r, i = heapq.heappop(queue)
            if not alive[i] or end[i] >= count:
                continue
            j = end[i]
            if ranks.get(data[i : end[j]]) != r:  # a part has changed since
                continue
            end[i], alive[j] = end[j], False
            if end[i] < count:
                before[end[i]] = i
                r = ranks.get(data[i : end[end[i]]])
                if r is not None:
                    heapq.heappush(queue, (r, i))
            if before[i] >= 0:
                r = ranks.get(data[before[i] : end[i]])
                if r is not None:
                    heapq.heappush(queue, (r, before[i]))
        out, i = [], 0
        while i < count:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return tuple(out)

    def spell(self, ids: pa.Array) -> pa.LargeBinaryArray:
        """The bytes of each id, one behind the other in one buffer."""
        found = self.spelled.take(ids)
        if found.null_count:
            raise KeyError("an id that no token has")
        return found

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of all ids together."""
        return b"".join(self.spell(pa.array(ids, pa.int32())).to_pylist())


def _codec(path: str, pattern: str) -> TreeBPE:
    return worker_cache(f"bpe-{path}", lambda: TreeBPE(read_ranks(path), pattern))


def bpe_encode(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", keep: bool = True
) -> DataFrame:
    """``doc_id, ids`` of each row: the ids of its whole text.

    ``path`` names a rank file that every worker can read (part of its image, like
    Python itself). Null and empty texts have no ids. Repeated rows give repeated
    results; an empty table gives none; other columns are ignored. Workers keep the
    pieces they have met for their next task; without ``keep`` they drop them, which
    leaves the memory to the stages that follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in text_slices(batches, "text"):
            ids = [codec.packed(t or "") for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"]
            )
        if not keep:
            codec.forget()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary) added: the bytes of ``ids``; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                column = part.column("ids")
                found = codec.spell(column.flatten())
                starts = np.append(0, np.cumsum(pc.binary_length(found).to_numpy(zero_copy_only=False), dtype=np.int64))
                ends = starts[np.cumsum([0, *_sizes(column)])]
                data = found.buffers()[2] or pa.py_buffer(b"")
                decoded = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(column), [None, pa.py_buffer(ends.tobytes()), data]
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, decoded.cast(pa.binary())], names=[*part.schema.names, "decoded"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def _sizes(column: pa.ListArray) -> list[int]:
    return [0 if n is None else n for n in pc.list_value_length(column).to_pylist()]
