"""Removal of repeated passages with a sparse, hash-compared suffix sort.

Every ``SPAN``-byte string holds ``SPAN - GRAM + 1`` grams; the one of least hash
is its anchor, so equal strings have equal anchors at equal places, and a run of
consecutive strings with one anchor is a *context*. Only about one byte in sixteen
is an anchor.

1. All contexts meet by anchor, sorted and streamed. A context that also stands in
   a document with a smaller id is repeated as a whole; contexts whose anchor has
   contexts of one document only are unique. Both are settled by two 64-bit hashes.
   Copies of a context that one task reads are combined before they move: only those
   of the smallest document go to the anchor, the others are known to be repeated.
2. What is left stands at the edges of repeated passages. The bytes after the anchors
   of these contexts are sorted as suffixes, and so are the bytes before them, read
   backwards: a merge sort whose comparisons find the common extension of two suffixes
   by binary search over prefix polynomial hashes, so a comparison takes logarithmic
   time. What neighbours have in common is compared byte by byte before it counts. Two
   strings are equal if they agree before and after their anchors, so two sorted
   suffixes a context tell all its strings; the smallest document of equal strings
   keeps its own.

Nothing but anchors, the contexts of step 2 and byte ranges is ever grouped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from presslake.llm.common import flat_text, mix, powers, prefix_hashes, span_hashes, text_slices
from presslake.llm.components import _written

SPAN = 50
GRAM = 20
GRAMS = SPAN - GRAM + 1
PIECE = 1 << 19
BESIDE = SPAN - GRAM  # bytes of a string that are not its anchor
CHUNK_CONTEXTS = 10_000  # the arrays of their suffixes stay in the processor's cache
SETTLE_ROWS = 1 << 15
BLOCK_ROWS = 1 << 16
HOT_CONTEXTS = 100_000
SEEN_CONTEXTS = 1 << 16
SETTLED = np.int64(1) << np.int64(62)  # flag of a place: the context is repeated
# A place: the text's number among the texts of its id, the first byte, the number of bytes.
SIZE_BITS, BYTE_BITS, TWIN_BITS = 8, 31, 22
ANCHOR_BASE = 0xD6E8FEB86659FD93
CONTEXT_BASE = 0xA0761D6478BD642F
_LETTERS = np.random.default_rng(23).integers(1, 1 << 63, 256).astype(np.uint64)
_PLACE = np.uint64((1 << 21) - 1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    prefix = prefix_hashes(_LETTERS[data], ANCHOR_BASE)
    spans = prefix[GRAM:] - prefix[:-GRAM]
    spans *= powers(len(prefix), ANCHOR_BASE)[1][: len(spans)]
    return mix(spans)


def contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``anchor, context, start, end`` of all contexts; places are in ``data``, rows start at ``offsets``."""
    if len(data) < SPAN:
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    grams = _gram_hashes(data)
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[: -(GRAMS - 16)], least[GRAMS - 16 :])
    inside = np.zeros(len(data) + 1, np.int8)
    long = np.diff(offsets) >= SPAN
    inside[offsets[:-1][long]] += 1
    inside[offsets[1:][long] - SPAN + 1] -= 1
    inside = np.cumsum(inside[: len(least)], dtype=np.int8) > 0
    anchor = (least & _PLACE).astype(np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
    start, end = np.flatnonzero(first), np.flatnonzero(last) + SPAN
    place = anchor[start]
    prefix = prefix_hashes(_LETTERS[data], CONTEXT_BASE)
    whole = span_hashes(prefix, start, end, CONTEXT_BASE)
    return grams[place], mix(whole + mix((place - start).astype(np.uint64))), start, end


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Bytes, row offsets, first row and first place; a long text comes alone, in overlapping pieces."""
    data, offsets = flat_text(batch.column("text"))
    most, first = 2 * PIECE - SPAN, 0
    while first < batch.num_rows:
        stop = max(int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1, first + 1)
        part = data[offsets[first] : offsets[stop]]
        if len(part) <= most:
            yield part, offsets[first : stop + 1] - offsets[first], first, 0
        else:
            for begin in range(0, len(part), PIECE):
                piece = part[begin : begin + PIECE + SPAN - 1]
                yield piece, np.array([0, len(piece)]), first, begin
        first = stop


class SeenContexts:
    """Contexts that a task met in several documents, with the smallest of these; of bounded size.

    A context that has left the task for a smaller document is repeated, whatever
    other tasks hold. So a passage that a third of all documents share reaches its
    anchor as few rows a task, not as one a document. Forgotten contexts only cost rows.
    """

    def __init__(self):
        self.context, self.anchor = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.doc = np.zeros(0, np.int64)

    def repeated(self, anchor: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which rows repeat a context of a smaller document, seen here before or in the same rows."""
        gone = np.zeros(len(context), bool)
        known = np.zeros(len(context), bool)
        if len(self.context) and len(context):
            at = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
            known = (self.context[at] == context) & (self.anchor[at] == anchor)
            gone = known & (doc > self.doc[at])
            np.minimum.at(self.doc, at[known], doc[known])
        order = np.argsort(context)
        same = context[order[1:]] == context[order[:-1]]
        several = np.zeros(len(context), bool)
        several[1:] = same
        several[:-1] |= same
        rows = order[several]
        if not len(rows):
            return gone
        rows = rows[np.lexsort((doc[rows], anchor[rows], context[rows]))]
        head = np.concatenate([[True], (context[rows[1:]] != context[rows[:-1]]) | (anchor[rows[1:]] != anchor[rows[:-1]])])
        first = rows[head]
        gone[rows] |= doc[rows] > doc[first][np.cumsum(head) - 1]
        last = rows[np.append(np.flatnonzero(head)[1:], len(rows)) - 1]
        self._remember(first[(doc[last] > doc[first]) & ~known[first]], anchor, context, doc)
        return gone

    def _remember(self, rows: np.ndarray, anchor: np.ndarray, context: np.ndarray, doc: np.ndarray) -> None:
        rows = rows[:SEEN_CONTEXTS]
        old = slice(0, len(self.context) if len(self.context) + len(rows) <= SEEN_CONTEXTS else 0)
        merged = np.concatenate([self.context[old], context[rows]])
        order = np.argsort(merged, kind="stable")
        self.context = merged[order]
        self.anchor = np.concatenate([self.anchor[old], anchor[rows]])[order]
        self.doc = np.concatenate([self.doc[old], doc[rows]])[order]


def _emit_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = SeenContexts()
    for batch in text_slices(batches, "text", PIECE):
        ids, twins = batch.column("doc_id").to_numpy(), batch.column("twin").to_numpy()
        for data, offsets, head, base in _pieces(batch):
            anchor, context, start, end = contexts(data, offsets)
            row = np.searchsorted(offsets, start, side="right") - 1
            place = (twins[head + row] << BYTE_BITS | start - offsets[row] + base) << SIZE_BITS | (end - start)
            doc = ids[head + row]
            settled = seen.repeated(anchor, context, doc)
            # Settled rows need not meet others: they are spread over all tasks.
            anchor[settled] = mix(mix(doc[settled].astype(np.uint64)) + place[settled].astype(np.uint64))
            place[settled] |= SETTLED
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(doc), pa.array(place)],
                names=["anchor", "context", "doc_id", "place"],
            )


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[np.ndarray]:
    """The columns of batches of integers as matrices of ``least`` rows or more, but for the last one."""
    held: list[np.ndarray] = []
    rows = 0
    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy() for i in range(batch.num_columns)]))
        rows += batch.num_rows
        if rows >= least:
            yield np.concatenate(held, axis=1)
            held, rows = [], 0
    if rows:
        yield np.concatenate(held, axis=1)


def _told(doc: np.ndarray, place: np.ndarray, repeated: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(place), pa.array(repeated)], names=["doc_id", "place", "repeated"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor, context and document: drop unique ones, tell repeated from open ones.

    A context belongs to its smallest document; it is open if its anchor also has
    contexts that belong to another one. The last anchor of a block may go on in the
    next: the places that could still become open (those of one document) wait, and
    a row that stands for the last context is carried over.
    """
    mark = np.zeros((4, 0), np.int64)
    several = False  # contexts of the mark's anchor belong to several documents
    waiting: list[np.ndarray] = []
    for fresh in _blocks(batches, SETTLE_ROWS):
        settled = (fresh[3] & SETTLED) != 0
        if settled.any():
            done = fresh[:, settled]
            yield _told(done[2], done[3] ^ SETTLED, np.ones(done.shape[1], bool))
            fresh = fresh[:, ~settled]
        if not fresh.shape[1]:
            continue
        if mark.shape[1] and mark[0, 0] != fresh[0, 0]:
            mark, several, waiting = mark[:, :0], False, []
        anchor, context, doc, place = np.concatenate([mark, fresh], axis=1)
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new_context = new_anchor | np.concatenate([[True], context[1:] != context[:-1]])
        begin = np.flatnonzero(new_context)
        owners = doc[begin]  # smallest document of each context
        owner = owners[np.cumsum(new_context) - 1]
        heads = np.flatnonzero(new_anchor[begin])
        mixed = np.minimum.reduceat(owners, heads) != np.maximum.reduceat(owners, heads)
        mixed[0] |= several
        group = np.cumsum(new_anchor) - 1
        first = doc == owner
        out = ~first | mixed[group]
        out[: mark.shape[1]] = False
        if mixed[0]:
            for places in waiting:
                yield _told(np.full(len(places), mark[2, 0]), places, np.zeros(len(places), bool))
        if mixed[0] or len(mixed) > 1:
            waiting = []
        several = bool(mixed[-1])
        if not several:
            tail = first & (group == group[-1])
            tail[: mark.shape[1]] = False
            waiting.append(place[tail])
        mark = np.array([[anchor[-1]], [context[-1]], [owner[-1]], [0]])
        yield _told(doc[out], place[out], ~first[out])


def _open_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the open contexts out of their texts and find their anchors again."""
    for batch in text_slices(batches, "text", PIECE):
        data, offsets = flat_text(batch.column("text"))
        column = batch.column("open")
        count = np.diff(column.offsets.to_numpy())
        place = column.flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), count)
        spot, size = place >> SIZE_BITS, place & ((1 << SIZE_BITS) - 1)
        begin = spot & ((1 << BYTE_BITS) - 1)
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(offsets[row] + begin - ends[:-1], size) + np.arange(ends[-1])
        flat = data[at]
        if len(flat) < GRAM:
            continue
        grams = _gram_hashes(flat)
        window = grams[ends[:-1, None] + np.arange(GRAMS)]
        lead = (window & ~_PLACE).argmin(axis=1)
        anchor = window[np.arange(len(lead)), lead]
        cells = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]
        )
        ids = batch.column("doc_id").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor.view(np.int64)), pa.array(lead), pa.array(ids[row]), pa.array(spot), cells.cast(pa.binary())],
            names=["anchor", "lead", "doc_id", "begin", "bytes"],
        )


class SuffixSort:
    """Sorts ``span``-byte strings of a buffer; comparisons read prefix hashes, not bytes."""

    def __init__(self, data: np.ndarray, span: int = SPAN):
        self.data = data
        self.span = span
        self.prefix = prefix_hashes(_LETTERS[data], CONTEXT_BASE)
        self.back = powers(len(self.prefix), CONTEXT_BASE)[1]

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of the strings at ``x`` and ``y``, at most ``span``."""
        out = np.full(len(x), self.span)
        at = self.prefix.take
        from_x, from_y, back_x, back_y = at(x), at(y), self.back.take(x), self.back.take(y)
        whole = (at(x + self.span) - from_x) * back_x == (at(y + self.span) - from_y) * back_y
        differ = np.flatnonzero(~whole)
        x, y, from_x, from_y, back_x, back_y = (v.take(differ) for v in (x, y, from_x, from_y, back_x, back_y))
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.span - 1)
        for _ in range((self.span - 1).bit_length()):
            middle = (low + high + 1) >> 1
            same = (at(x + middle) - from_x) * back_x == (at(y + middle) - from_y) * back_y
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        out[differ] = low
        return out

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair of strings."""
        common = self.extension(x, y)
        at = np.minimum(common, self.span - 1)
        order = np.sign(self.data[x + at].astype(np.int16) - self.data[y + at].astype(np.int16))
        return np.where(common >= self.span, 0, order)

    def sort(self, places: np.ndarray, group: np.ndarray) -> np.ndarray:
        """A stable order of ``places`` by string inside each run of equal ``group``.

        Strings that agree on their first eight bytes go through a bottom-up merge
        sort. All pairs of runs of one width merge at once, but for those that are in
        order already; an element's place is its rank in its own run plus its rank in
        the neighbouring run, found by binary search.
        """
        if not len(places):
            return np.arange(0)
        word = self.data[places[:, None] + np.arange(8)].view(">u8").ravel().astype(np.uint64)
        new = np.concatenate([[True], group[1:] != group[:-1]])
        order = np.lexsort((word, np.cumsum(new)))
        new[1:] |= word[order[1:]] != word[order[:-1]]
        size = np.diff(np.append(np.flatnonzero(new), len(places)))
        begin, size = np.repeat(np.flatnonzero(new), size), np.repeat(size, size)
        width, most = 1, size.max()
        while width < most:
            spot = np.flatnonzero(size > width)
            head = spot[((spot - begin[spot]) % (2 * width) == 0) & (spot + width < begin[spot] + size[spot])]
            head = head[self.compare(places[order[head + width - 1]], places[order[head + width]]) > 0]
            stop = np.minimum(head + 2 * width, begin[head] + size[head])
            if width == 1:
                order[head], order[head + 1] = order[head + 1], order[head]
            elif len(head):
                order = self._merged(places, order, head, width, stop)
            width *= 2
        return order

    def _merged(self, places: np.ndarray, order: np.ndarray, head: np.ndarray, width: int, stop: np.ndarray) -> np.ndarray:
        """``order`` with the runs ``[head, head + width)`` and ``[head + width, stop)`` merged."""
        count = stop - head
        pair, end = np.repeat(head, count), np.repeat(stop, count)
        spot = pair + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        left = spot < pair + width
        low, high = np.where(left, pair + width, pair), np.where(left, end, pair + width)
        other, own = low.copy(), np.where(left, pair, pair + width)
        active = np.arange(len(spot))
        mine = places[order[spot]]
        while len(active):
            middle = (low[active] + high[active]) >> 1
            sign = self.compare(places[order[middle]], mine[active])
            before = np.where(left[active], sign < 0, sign <= 0)
            low[active] = np.where(before, middle + 1, low[active])
            high[active] = np.where(before, high[active], middle)
            active = active[low[active] < high[active]]
        moved = order.copy()
        moved[pair + (spot - own) + (low - other)] = order[spot]
        return moved

    def common_with_previous(self, places: np.ndarray) -> np.ndarray:
        """How many bytes each string has in common with the one before it; equal hashes are checked byte by byte."""
        common = np.zeros(len(places), np.int64)
        steps = np.arange(self.span)
        for begin in range(1, len(places), BLOCK_ROWS):
            here = places[begin : begin + BLOCK_ROWS]
            last = places[begin - 1 : begin - 1 + len(here)]
            differ = self.data[here[:, None] + steps] != self.data[last[:, None] + steps]
            checked = np.where(differ.any(axis=1), differ.argmax(axis=1), self.span)
            common[begin : begin + len(here)] = np.minimum(self.extension(last, here), checked)
        return common

    def equal_to_previous(self, places: np.ndarray) -> np.ndarray:
        """Whether each string equals the one before it."""
        return self.common_with_previous(places) >= self.span


def _cells(data: np.ndarray, at: np.ndarray, step: int, count: np.ndarray, width: int) -> np.ndarray:
    """For each row ``count`` bytes from ``at`` on, forwards or backwards, and zeros up to ``width``."""
    out = np.empty((len(at), width), np.uint8)
    steps = np.arange(width)
    for begin in range(0, len(at), BLOCK_ROWS):
        part = slice(begin, begin + BLOCK_ROWS)
        cells = data.take(at[part, None] + step * steps, mode="clip")
        out[part] = np.where(steps < count[part, None], cells, np.uint8(0))
    return out


def _sorted_suffixes(cells: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rank, common, near`` of rows of ``BESIDE`` bytes, ordered within their groups.

    Equal rows of a group share a rank; ``common`` tells by rank how many bytes there
    are in common with the rank before it (-1: starts a group), and ``near`` by row
    the most that a row has in common with another one of its group (-1: has none).
    Only different rows are sorted, so a group of many equal ones stays small.
    """
    words = np.zeros((len(cells), -(-BESIDE // 8) * 8), np.uint8)
    words[:, :BESIDE] = cells
    words = words.view(np.uint64)
    whole = words[:, 0].copy()
    for column in range(1, words.shape[1]):
        whole = mix(whole) + words[:, column]
    order = np.lexsort((whole, group))
    same = (words[order[1:]] == words[order[:-1]]).all(axis=1) & (group[order[1:]] == group[order[:-1]])
    kind = np.cumsum(np.concatenate([[True], ~same])) - 1
    count = np.bincount(kind)
    different = order[np.cumsum(count) - count]
    cells, owner = cells[different], group[different]
    suffixes = SuffixSort(cells.ravel(), BESIDE)
    sort = suffixes.sort(np.arange(len(cells)) * BESIDE, owner)
    common = suffixes.common_with_previous(sort * BESIDE)
    common[np.concatenate([[True], owner[1:] != owner[:-1]])] = -1
    place = np.empty(len(sort), np.int64)
    place[sort] = np.arange(len(sort))
    rank = np.empty(len(order), np.int64)
    rank[order] = place[kind]
    near = np.where(count[sort] > 1, BESIDE, np.maximum(common, np.append(common[1:], -1)))
    return rank, common, near[rank]


def _repeated_in(table: pa.Table) -> pa.RecordBatch:
    """Byte ranges of strings that also stand in a smaller document; whole groups of contexts come in."""
    table = table.combine_chunks()
    cells = table.column("bytes").combine_chunks()
    offsets = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1].astype(np.int64)
    data = np.frombuffer(cells.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    key = np.stack([table.column("anchor").to_numpy(), table.column("salt").to_numpy()])
    new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])
    group = np.cumsum(new) - 1
    lead, doc, begin = (table.column(c).to_numpy() for c in ("lead", "doc_id", "begin"))
    at = offsets[:-1] - offsets[0] + lead
    after = np.diff(offsets) - lead - GRAM
    # Anchors of one group have equal hashes; should their bytes differ, the group falls apart.
    grams = _cells(data, at, 1, np.full(len(at), GRAM), GRAM)
    if (grams != grams[np.flatnonzero(new)[group]]).any():
        kind = np.unique(grams, axis=0, return_inverse=True)[1].ravel()
        order = np.lexsort((kind, group))
        lead, doc, begin, at, after = (x[order] for x in (lead, doc, begin, at, after))
        split = (group[order[1:]] != group[order[:-1]]) | (kind[order[1:]] != kind[order[:-1]])
        group = np.concatenate([[0], np.cumsum(split)])
    before = _sorted_suffixes(_cells(data, at - 1, -1, lead, BESIDE), group)
    behind = _sorted_suffixes(_cells(data, at + GRAM, 1, after, BESIDE), group)
    # A string with ``place`` bytes before its anchor has an equal only if both sides have.
    low, high = BESIDE - np.minimum(after, behind[2]), np.minimum(lead, before[2])
    least, most = np.full(len(lead), 1 << 30), np.full(len(lead), -1)
    for place in range(BESIDE + 1):
        rows = np.flatnonzero((low <= place) & (place <= high))
        if len(rows) < 2:
            continue
        kinds = [np.cumsum(common < depth)[rank[rows]] for (rank, common, _), depth in ((before, place), (behind, BESIDE - place))]
        both = kinds[0] * (len(lead) + 1) + kinds[1]
        order = np.argsort(both)
        both, rows = both[order], rows[order]
        heads = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        owner = np.repeat(np.minimum.reduceat(doc[rows], heads), np.diff(np.append(heads, len(rows))))
        gone = rows[doc[rows] > owner]
        shift = lead[gone] - place
        least[gone] = np.minimum(least[gone], shift)
        most[gone] = np.maximum(most[gone], shift)
    hit = most >= 0
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[hit]), pa.array(begin[hit] + least[hit]), pa.array(begin[hit] + most[hit] + SPAN)],
        names=["doc_id", "start", "end"],
    )


def _sort_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feed whole groups of contexts, sorted by anchor and salt, to the suffix sort."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, CHUNK_CONTEXTS):
            part = batch.slice(begin, CHUNK_CONTEXTS)
            waiting.append(part)
            rows += part.num_rows
            last = part.num_rows - 1
            one_group = all(waiting[0].column(c)[0] == part.column(c)[last] for c in ("anchor", "salt"))
            if rows < CHUNK_CONTEXTS or one_group:  # a group that fills a chunk waits for its end
                continue
            table = pa.Table.from_batches(waiting)
            anchor, salt = table.column("anchor").to_numpy(), table.column("salt").to_numpy()
            cut = int(np.flatnonzero((anchor != anchor[-1]) | (salt != salt[-1]))[-1]) + 1
            yield _repeated_in(table.slice(0, cut))
            waiting = table.slice(cut).combine_chunks().to_batches()
            rows = sum(b.num_rows for b in waiting)
    if waiting and sum(b.num_rows for b in waiting):
        yield _repeated_in(pa.Table.from_batches(waiting))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the ranges of each text and remove their bytes."""
    for batch in text_slices(batches, "text", PIECE):
        data, offsets = flat_text(batch.column("text"))
        column = batch.column("ranges")
        ends = column.offsets.to_numpy()
        flat = column.flatten()
        start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        ends = ends - ends[0]
        row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
        change = np.zeros(len(data) + 1, np.int32)
        size = np.diff(offsets)
        np.add.at(change, offsets[row] + np.minimum(start, size[row]), 1)
        np.add.at(change, offsets[row] + np.minimum(end, size[row]), -1)
        gone = np.cumsum(change[:-1]) > 0
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        edges = offsets[1:-1][(offsets[1:-1] < len(data))]
        first[edges] = gone[edges]
        last = gone.copy()
        last[:-1] &= ~gone[1:]
        edges = edges[edges > 0]
        last[edges - 1] = gone[edges - 1]
        begins, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        owner = np.searchsorted(offsets, begins, side="right") - 1
        span_ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        kept_ends = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            batch.num_rows,
            [None, pa.py_buffer(kept_ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~gone]))],
        )
        spans = pa.StructArray.from_arrays(
            [pa.array(begins - offsets[owner]), pa.array(stops - offsets[owner])], names=["start", "end"]
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(size),
                pa.ListArray.from_arrays(pa.array(span_ends.astype(np.int32)), spans),
                kept.cast(pa.binary()),
            ],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def _with_twins(rows: DataFrame) -> DataFrame:
    """Number the different texts of each id in a column ``twin``; almost always it is 0.

    Only ids and hashes of repeated ids are ranked. What is written for them has a
    known size, so Spark broadcasts it only where it is small.
    """
    keys = rows.select("doc_id", F.xxhash64("text").alias("h")).distinct()
    several = keys.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("h")).cast("long") - 1
    too_many = F.raise_error(F.concat(F.lit("more different texts than can be told apart have the id "), "doc_id"))
    number = F.when(rank < (1 << TWIN_BITS), rank).otherwise(too_many.cast("long"))
    twins = keys.join(several, "doc_id").select("doc_id", "h", number.alias("twin")).where("twin > 0")
    hashed = rows.withColumn("h", F.xxhash64("text"))
    joined = hashed.join(_written(twins, "twins"), ["doc_id", "h"], "left")
    return joined.select("doc_id", "text", F.coalesce("twin", F.lit(0).cast("long")).alias("twin"))


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, and the shuffles behind it let go: Spark deletes them when its driver collects garbage."""
    staged = _written(df, name)
    df.sparkSession._jvm.System.gc()
    return staged


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row ``doc_id, n_bytes, spans, kept``: its text without repeated passages.

    ``spans`` are the maximal removed byte ranges: bytes covered by a string of
    ``SPAN`` bytes that also starts in a document with a smaller (integer) id.
    Strings are judged on the input. ``kept`` holds the other bytes. Null texts are
    empty. A row without id loses nothing and takes nothing from others. Rows that
    share an id take nothing from each other, whatever their texts; each is judged
    against the smaller ids and counts for the larger ones (up to ``2**TWIN_BITS``
    different texts of one id; beyond that the job fails). Rows that share id and
    text are judged alike. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    judged = _with_twins(rows.where("doc_id is not null"))
    aside = rows.where("doc_id is null")

    emitted = judged.mapInArrow(_emit_contexts, "anchor long, context long, doc_id long, place long")
    met = emitted.repartition("anchor").sortWithinPartitions("anchor", "context", "doc_id")
    found = _staged(met.mapInArrow(_settle, "doc_id long, place long, repeated boolean"), "contexts")

    # Open contexts get their bytes; an anchor with very many of them is dealt out by string.
    twin = F.shiftright("place", SIZE_BITS + BYTE_BITS).alias("twin")
    opened = found.where("not repeated").groupBy("doc_id", twin).agg(F.collect_set("place").alias("open"))
    cut = judged.join(opened, ["doc_id", "twin"]).mapInArrow(
        _open_contexts, "anchor long, lead long, doc_id long, begin long, bytes binary"
    )
    cut = _staged(cut, "open-contexts")
    hot = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_CONTEXTS)
    hot = _staged(hot, "hot-anchors")  # of known size: where it is small, the contexts need not move for it
    plain = cut.join(hot, "anchor", "left_anti").withColumn("salt", F.lit(0).cast("long"))
    step = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - SPAN)).alias("step")
    strings = cut.join(hot, "anchor").select("*", step).select(
        "anchor",
        (F.col("lead") - F.col("step")).alias("lead"),
        "doc_id",
        (F.col("begin") + F.col("step")).alias("begin"),
        F.substring("bytes", F.col("step") + 1, F.lit(SPAN)).alias("bytes"),
        "n",
    )
    salt = F.pmod(F.xxhash64("bytes"), F.ceil(F.col("n") / HOT_CONTEXTS) * SPAN)
    strings = strings.withColumn("salt", salt.cast("long")).drop("n")
    edges = (
        plain.unionByName(strings)
        .repartition("anchor", "salt")
        .sortWithinPartitions("anchor", "salt")
        .mapInArrow(_sort_contexts, "doc_id long, start long, end long")
    )

    start = F.shiftright("place", SIZE_BITS)
    end = start + F.col("place").bitwiseAND((1 << SIZE_BITS) - 1)
    whole = found.where("repeated").select("doc_id", start.alias("start"), end.alias("end"))
    of_text = F.struct(*(F.col(c).bitwiseAND((1 << BYTE_BITS) - 1).alias(c) for c in ("start", "end")))
    ranges = (
        whole.unionByName(edges)
        .groupBy("doc_id", F.shiftright("start", BYTE_BITS).alias("twin"))
        .agg(F.collect_list(of_text).alias("ranges"))
    )
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    with_ranges = judged.join(ranges, ["doc_id", "twin"], "left").select(
        "doc_id", "text", F.coalesce("ranges", none).alias("ranges")
    )
    return with_ranges.unionByName(aside.withColumn("ranges", none)).mapInArrow(
        _cut_out, "doc_id long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    )
