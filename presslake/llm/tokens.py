"""Token ids in binary shards, compressed by Re-Pair.

A shard holds the ids of consecutive documents. Compression repeatedly replaces
frequent neighbouring pairs of symbols by new symbols, until no pair occurs twice;
each round replaces at once, from left to right without overlap, all pairs that are
at least half as frequent as the most frequent one. Counts and places of the pairs
are kept from round to round.
The shard stores the rules, how many ids each rule expands to,
and the id position of every ``STRIDE``-th symbol, so a range of ids is decoded
from the few symbols that cover it.

Shards are rows of a Parquet table (``SHARD_DDL``): task and number give their
order, ``before`` is the number of ids the task wrote earlier, ``docs`` and
``sizes`` name the documents, the rest is little-endian binary.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from presslake.llm.common import text_slices, worker_cache

SHARD_IDS = 1 << 20
LEAST_COUNT = 2
STRIDE = 1024
CACHED_CHUNKS = 400_000
SLICE_BYTES = 1 << 23

SHARD_DDL = (
    "task int, number long, before long, n_ids long, docs array<{kind}>, sizes array<long>, "
    "first_symbol int, rules binary, lengths binary, symbols binary, places binary"
)


@dataclass
class Grammar:
    """``symbols`` below ``first`` are ids; rule ``r`` is symbol ``first + r`` and stands for ``rules[r]``."""

    first: int
    rules: np.ndarray  # n x 2 symbols
    lengths: np.ndarray  # ids that each rule expands to
    symbols: np.ndarray
    places: np.ndarray  # id position of every STRIDE-th symbol

    def size_of(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        rule = np.flatnonzero(symbols >= self.first)
        out[rule] = self.lengths.take(symbols.take(rule) - self.first)
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """All ids under ``symbols``; a rule is written where it begins, and its two parts over it."""
        sizes = self.size_of(symbols)
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        first, second = np.ascontiguousarray(self.rules.T)
        middle, at = self.size_of(first), ends - sizes
        while len(symbols):
            out[at] = symbols
            rule = np.flatnonzero(symbols >= self.first)
            at, which = at.take(rule), (symbols.take(rule) - self.first).astype(np.intp)
            symbols = np.concatenate([first.take(which), second.take(which)])
            at = np.concatenate([at, at + middle.take(which)])
        return out

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` from the symbols that cover them."""
        if count <= 0 or not len(self.symbols):
            return np.zeros(0, np.int32)
        block = int(np.searchsorted(self.places, start, side="right")) - 1
        stop = int(np.searchsorted(self.places, start + count, side="left"))
        part = self.symbols[block * STRIDE : stop * STRIDE]
        ends = np.cumsum(self.size_of(part)) + self.places[block]
        a = int(np.searchsorted(ends, start, side="right"))
        b = int(np.searchsorted(ends, start + count, side="left")) + 1
        before = int(ends[a - 1]) if a else int(self.places[block])
        return self.expand(part[a:b])[start - before : start - before + count]


def repair(ids: np.ndarray, first: int) -> Grammar:
    """Compress ids, all below ``first``."""
    chain, rules, lengths = _Chain(ids, first), [], np.zeros(0, np.int64)
    grammar = Grammar(first, np.zeros((0, 2), np.int32), lengths, ids, np.zeros(0, np.int64))
    while True:
        places, which = chain.frequent()
        if not len(places):
            break
        kinds = int(which.max()) + 1
        place = np.empty(kinds, np.intp)
        place[which] = places  # any one of each pair
        picked = np.stack([chain.symbols.take(place), chain.symbols.take(chain.after.take(place))], axis=1) - 1
        rules.append(picked)
        chain.replace(places, which, kinds)
        parts = grammar.size_of(picked.ravel()).reshape(-1, 2)
        grammar.lengths = lengths = np.concatenate([lengths, parts.sum(axis=1)])
    if rules:
        grammar.rules = np.concatenate(rules)
    grammar.symbols = chain.symbols.take(np.flatnonzero(chain.alive[:-1])) - 1
    sizes = grammar.size_of(grammar.symbols)
    grammar.places = (np.cumsum(sizes) - sizes)[::STRIDE]
    return grammar


class _Chain:
    """The symbols as a linked list, with the count and the places of every pair that occurs twice.

    A pair that is new after a round holds a symbol of that round. So pairs are
    counted once, where they arise; later they only lose places, and a round
    touches nothing but the places it replaces and their neighbours. Symbols are
    one higher than outside: 0 stands behind the last and before the first, so
    the pairs there are like none else. Pair 0 stands for all that occur once.
    """

    def __init__(self, ids: np.ndarray, first: int):
        count = len(ids)
        self.symbols = np.append(ids + 1, 0).astype(np.int32)
        self.top = first  # the highest symbol
        self.alive = np.ones(count + 1, bool)
        self.after = np.arange(1, count + 2, dtype=np.int32)
        self.before = np.arange(-1, count, dtype=np.int32)
        self.after[-1] = self.before[0] = count
        self.pair = np.zeros(count + 1, np.int32)  # number of the pair that begins at a place
        # Each replacement takes a symbol away and makes two pairs at most, hence the room.
        self.kinds = 1
        self.counts = np.zeros(3 * count // 2 + 2, np.int32)
        self.starts = np.zeros(3 * count // 2 + 3, np.int32)  # a pair arose at placed[starts[i] : starts[i + 1]]
        self.placed = np.empty(3 * count, np.int32)
        self._count(np.arange(count), self.symbols[:-1], self.symbols[1:])

    def _count(self, places: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Number the pairs ``left, right`` at ``places``, all of them new, that occur twice; no place has a number."""
        wide, deep = self.top.bit_length(), len(self.pair).bit_length()
        code = left.astype(np.int64)
        code <<= wide
        code |= right
        if 2 * wide + deep < 64:  # sorted together, which is faster than by an order
            code <<= deep
            code |= places
            code.sort()
            places = code & ((1 << deep) - 1)
            code >>= deep
        else:
            order = np.argsort(code)
            code, places = code[order], places[order]
        same = np.zeros(len(code) + 1, bool)
        np.equal(code[1:], code[:-1], out=same[1:-1])
        places = places.take(np.flatnonzero(same[1:] | same[:-1]))
        begin = np.flatnonzero(same[1:] > same[:-1])
        sizes = np.flatnonzero(same[1:] < same[:-1]) + 1 - begin
        old, new = self.kinds, self.kinds + len(sizes)
        self.pair[places] = np.repeat(np.arange(old, new, dtype=np.int32), sizes)
        self.counts[old:new] = sizes
        self.starts[old + 1 : new + 1] = self.starts[old] + np.cumsum(sizes)
        self.placed[self.starts[old] : self.starts[new]] = places
        self.kinds = new

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """Places to replace without overlap, in ascending order, and which of the picked pairs each holds.

        Pairs whose places mostly overlap those of others wait. If all are in
        others' way, one that cannot overlap itself is taken alone.
        """
        counts = self.counts[: self.kinds]
        while True:
            least = max(int(counts.max()) // 2, LEAST_COUNT)
            kinds = np.flatnonzero(counts >= least)
            if not len(kinds):
                return np.zeros(0, np.intp), np.zeros(0, np.intp)
            places = self._places(kinds)
            rank = np.empty(self.kinds, np.intp)
            rank[kinds] = np.arange(len(kinds))
            for alone in (False, True):
                if alone:
                    mixed = self.symbols[places] != self.symbols[self.after[places]]
                    places = places[self.pair[places] == self.pair[places[int(mixed.argmax())]]]
                tried = self._apart(places)
                which = rank.take(self.pair.take(tried))
                enough = np.bincount(which, minlength=len(kinds)) >= max(least // 2, LEAST_COUNT)
                if enough.all():
                    return tried, which
                if enough.any():
                    stay = np.flatnonzero(enough.take(which))
                    return tried.take(stay), (np.cumsum(enough) - 1).take(which.take(stay))
            counts[kinds] = 0  # each is one run of three equal symbols, which holds the pair once

    def _places(self, kinds: np.ndarray) -> np.ndarray:
        """Where the pairs ``kinds`` still stand, in ascending order."""
        begin = self.starts.take(kinds).astype(np.intp)
        sizes = self.starts.take(kinds + 1) - begin
        ends = np.cumsum(sizes)
        at = np.repeat(begin - (ends - sizes), sizes)
        at += np.arange(len(at))
        places = self.placed.take(at)
        places = places.take(np.flatnonzero(self.pair.take(places) == np.repeat(kinds.astype(np.int32), sizes)))
        places.sort()
        return places.astype(np.intp)

    def _apart(self, places: np.ndarray) -> np.ndarray:
        """Of places that follow one another, every other one from the left."""
        tied = np.flatnonzero(self.after.take(places[:-1]) == places[1:]) + 1
        if not len(tied):
            return places
        # A run of ties: the first, third and so on of them go.
        fresh = np.ones(len(tied), bool)
        fresh[1:] = np.diff(tied) > 1
        order = np.arange(len(tied))
        odd = (order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0
        stay = np.ones(len(places), bool)
        stay[tied[odd]] = False
        return places.take(np.flatnonzero(stay))

    def replace(self, places: np.ndarray, which: np.ndarray, kinds: int) -> None:
        """Write the next ``kinds`` symbols for the pairs at ``places``, which do not overlap."""
        gone, left = self.after.take(places).astype(np.intp), self.before.take(places).astype(np.intp)
        for at in (places, gone, left):
            np.subtract.at(self.counts, self.pair.take(at).astype(np.intp), np.int32(1))
            self.pair[at] = 0
        self.counts[0] = 0
        self.alive[gone] = False
        new = (self.top + 1 + which).astype(np.int32)
        self.symbols[places] = new
        self.top += kinds
        behind = self.after.take(gone).astype(np.intp)
        self.after[places], self.before[behind] = behind, places
        stay = np.flatnonzero(self.alive.take(left))
        left = left.take(stay)
        self._count(
            np.concatenate([places, left]),
            np.concatenate([new, self.symbols.take(left)]),
            np.concatenate([self.symbols.take(behind), new.take(stay)]),
        )


class ChunkTokenizer:
    """The tokenizers library behind a cache of words and their tails.

    The vocabulary drops white space and never merges across it, so the ids of a
    text are those of its blank-separated chunks; ASCII text is lower-cased first,
    as the tokenizer does itself. It also parts letters from punctuation, so a word
    with a tail of marks is encoded as the two. Each distinct word of many texts is
    looked up once, in one join with those known, and the ids are gathered for all
    of them together. New words go to the library many at a time: a word is one run
    of letters, and only its last id is one with the end mark. Words of Latin-1
    letters come normalised and parted as the library would do it, so they go to
    its model without those steps.
    """

    TAIL = ".,;:!?%$#&*)(\"-"
    JOINED = 1024

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain, self.latin = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        blanks, spelled = pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = blanks  # the bytes of ASCII are spelled as they are
        self.latin.pre_tokenizer = pre_tokenizers.Sequence([blanks, spelled])
        vocabulary = self.tokenizer.get_vocab()
        self.first_free = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.first_free, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        # Words, tails and, behind a blank, other whole chunks; a line break stands for the end of a text.
        self.known = pa.array(["", "\n"], pa.large_string())
        self.others: dict[str, int] = {}  # the place in known of what is no word
        self.ids = np.zeros(1, np.uint32)
        self.stops = np.array([0, 0, 1])  # known[n] has ids[stops[n] : stops[n + 1]]
        self.again = np.ones(2, bool)  # known[n] was met again after it was learnt

    def trim(self) -> None:
        """Make room: only what was met again stays, and nothing where that is over half of the room."""
        keep = self.again.copy()
        if np.count_nonzero(keep) > CACHED_CHUNKS // 2:
            return self.forget()
        sizes = np.diff(self.stops)
        self.known = self.known.filter(pa.array(keep))
        self.ids = self.ids[np.repeat(keep, sizes)]
        self.stops = np.concatenate([[0], np.cumsum(sizes[keep])])
        place = np.cumsum(keep) - 1
        self.others = {name: int(place[n]) for name, n in self.others.items() if keep[n]}
        self.again = np.arange(len(self.known)) < 2

    def _each(self, chunks: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Encode chunks one by one: their ids end to end, and the number of ids of each."""
        for begin in range(0, len(chunks), 20_000):
            part = chunks[begin : begin + 20_000]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            yield np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _words(self, words: list[str], library) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As ``_each`` for runs of letters, many in one string; the ids are parted at the end marks."""
        for begin in range(0, len(words), 100 * self.JOINED):
            groups = [
                words[at : at + self.JOINED]
                for at in range(begin, min(begin + 100 * self.JOINED, len(words)), self.JOINED)
            ]
            joined = library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
            for group, found in zip(groups, joined):
                ids = np.array(found.ids, np.uint32)
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) == len(group):
                    yield ids, np.diff(stops, prepend=0)
                else:  # a letter that the library does not take for one
                    yield from self._each(group)

    def _learn(self, words: list[str], others: list[str]) -> None:
        """Encode words and others that are not known, and keep them."""
        plain, latin, rest = [], [], []
        for word in words:
            (plain if word.isascii() else latin if max(word) < "\u0100" else rest).append(word)
        # In texts that are not all ASCII, words keep their case.
        found = [
            *self._words([word.lower() for word in plain], self.plain),
            *self._words([word.lower() for word in latin], self.latin),
            *self._words(rest, self.tokenizer),
            *self._each(others),
        ]
        words = [*plain, *latin, *rest]
        self.others.update(zip(others, range(len(self.known) + len(words), len(self.known) + len(words) + len(others))))
        self.known = pa.concat_arrays([self.known, pa.array([*words, *others], pa.large_string())])
        self.ids = np.concatenate([self.ids, *(ids for ids, _ in found)])
        sizes = np.concatenate([np.zeros(0, np.int64), *(sizes for _, sizes in found)])
        self.stops = np.concatenate([self.stops, self.stops[-1] + np.cumsum(sizes)])
        self.again = np.concatenate([self.again, np.zeros(len(sizes), bool)])

    def _pieces(self, chunks: pa.Array) -> np.ndarray:
        """The places in ``known`` of each chunk's word and tail; of a chunk that is no word with a tail, of all of it."""
        stems = pc.utf8_rtrim(chunks, self.TAIL)
        coded = stems.dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy()
        places = pc.index_in(words, value_set=self.known)
        new = words.filter(places.is_null()).to_numpy(zero_copy_only=False).tolist()
        # Lower case may end in a mark that is no letter; the library joins it with what follows.
        odd = {word for word in new if not (word.isalpha() and (word.isascii() or word.lower().isalpha()))}
        whole = np.zeros(len(chunks), bool)
        if odd:
            whole = pc.is_in(words, value_set=pa.array(odd, pa.large_string())).to_numpy(zero_copy_only=False)[which]
        named = [f" {name}" for name in chunks.filter(pa.array(whole)).to_pylist()]
        size = pc.subtract(pc.binary_length(chunks), pc.binary_length(stems)).to_numpy()
        tailed = np.flatnonzero((size > 0) & ~whole)
        ends = chunks.take(pa.array(tailed)).to_numpy(zero_copy_only=False).tolist()
        tails = [name[-n:] for name, n in zip(ends, size[tailed].tolist())]  # marks are single bytes
        others = {*named, *tails}.difference(self.others)
        if len(self.known) + len(new) + len(others) > CACHED_CHUNKS and len(self.known) > 2:
            self.trim()
            return self._pieces(chunks)
        self.again[places.drop_null().to_numpy()] = True
        self.again[[self.others[name] for name in {*named, *tails}.difference(others)]] = True
        if new or others:
            begin = len(self.known)
            self._learn([word for word in new if word not in odd], [*others])
            latest = pc.index_in(words, value_set=self.known.slice(begin))
            places = pc.coalesce(places, pc.add(latest, begin))
        pieces = np.zeros((len(chunks), 2), np.intp)
        pieces[:, 0] = places.fill_null(0).to_numpy()[which]
        pieces[whole, 0] = [self.others[name] for name in named]
        pieces[tailed, 1] = [self.others[tail] for tail in tails]
        return pieces

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """For each text its ids and ``end``, as little-endian unsigned 32-bit integers."""
        # Special tokens are told by their exact spelling, so texts that may hold one keep theirs.
        lines = [(t.lower() if t.isascii() and "<|" not in t else t).replace("\n", " ") + " \n" for t in texts]
        split = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        pieces = self._pieces(coded.dictionary)
        self.ids[0] = end
        begin = self.stops.take(pieces)
        sizes = self.stops.take(pieces + 1) - begin
        stops = np.cumsum(sizes)
        place = np.repeat(begin.ravel() - (stops - sizes.ravel()), sizes.ravel())
        place += np.arange(len(place))
        ids = pa.py_buffer(self.ids.take(place).astype("<u4", copy=False))
        stops = pa.py_buffer(np.concatenate([[0], 4 * stops[1::2]]).astype(np.int64))
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), [None, stops, ids])
        found = chunks.take(coded.indices)  # their bytes stand end to end
        stops = np.frombuffer(found.buffers()[1], np.int64)[split.offsets.to_numpy()].tolist()
        data = memoryview(found.buffers()[2]) if len(found) else b""
        return [bytes(data[a:b]) for a, b in zip(stops, stops[1:])]


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS
) -> None:
    """Encode every row's whole text, append ``end``, and write shards in ascending order of id.

    ``tokenizer`` is a tokenizers file that every worker can read. Rows with equal
    ids go by a hash of their text, null ids come first; null texts are empty. A
    shard ends after the document that fills it, so a long document lies in one.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("check", F.xxhash64("text"))
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(shuffles, "doc_id", "check").sortWithinPartitions("doc_id", "check")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_cache(f"chunks-{tokenizer}", lambda: ChunkTokenizer(tokenizer))
        task, number, before, held, names, size = TaskContext.get().partitionId(), 0, 0, [], [], 0
        for batch in text_slices(batches, "text", SLICE_BYTES):
            id_kind = batch.column("doc_id").type
            for name, data in zip(batch.column("doc_id").to_pylist(), codec.encode(batch.column("text").to_pylist(), end)):
                held.append(data)
                names.append(name)
                size += len(data) // 4
                if size >= shard_ids:
                    yield _shard(task, number, before, names, held, codec.first_free, id_kind)
                    number, before, held, names, size = number + 1, before + size, [], [], 0
        if held:
            yield _shard(task, number, before, names, held, codec.first_free, id_kind)

    ordered.drop("check").mapInArrow(run, SHARD_DDL.format(kind=kind)).write.parquet(path)


def _shard(
    task: int, number: int, before: int, names: list, held: list[bytes], first: int, kind: pa.DataType
) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(held), "<u4").astype(np.int32)
    grammar = repair(ids, first)
    columns = {
        "task": pa.array([task], pa.int32()),
        "number": pa.array([number], pa.int64()),
        "before": pa.array([before], pa.int64()),
        "n_ids": pa.array([len(ids)], pa.int64()),
        "docs": pa.array([names], pa.list_(kind)),
        "sizes": pa.array([[len(d) // 4 for d in held]], pa.list_(pa.int64())),
        "first_symbol": pa.array([first], pa.int32()),
        "rules": pa.array([grammar.rules.astype("<i4").tobytes()], pa.binary()),
        "lengths": pa.array([grammar.lengths.astype("<i8").tobytes()], pa.binary()),
        "symbols": pa.array([grammar.symbols.astype("<i4").tobytes()], pa.binary()),
        "places": pa.array([grammar.places.astype("<i8").tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def grammar_of(row: dict) -> Grammar:
    """The grammar in a shard's row."""
    return Grammar(
        row["first_symbol"],
        np.frombuffer(row["rules"], "<i4").reshape(-1, 2),
        np.frombuffer(row["lengths"], "<i8"),
        np.frombuffer(row["symbols"], "<i4"),
        np.frombuffer(row["places"], "<i8"),
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the number of ids in all shards before.

    A shard knows how many ids its task had written before it, so only one total
    a writing task is summed in one place, and the shards themselves stay put.
    """
    shards = spark.read.parquet(path)
    totals = shards.groupBy("task").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("task", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(bases), "task")  # as many rows as tasks wrote the shards
    return placed.withColumn("start", F.col("base") + F.col("before"))


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the decoded shards."""
    kind = shards.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {name: batch.column(name)[row].as_py() for name in fields}
                grammar = grammar_of(shard)
                data = memoryview(grammar.expand(grammar.symbols).astype("<u4").tobytes())
                sizes = batch.column("sizes")[row].values.to_numpy()
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(data[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("docs")[row].values,
                        pa.array(shard["start"] + ends - sizes),
                        pa.array(sizes),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    fields = ["start", "first_symbol", "rules", "lengths", "symbols", "places"]
    return shards.select("docs", "sizes", *fields).mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def read_range(shards: DataFrame, start: int, count: int) -> list[int]:
    """Ids ``start`` to ``start + count`` of the whole sequence; only shards that overlap are read."""
    hit = shards.where((F.col("start") < start + count) & (F.col("start") + F.col("n_ids") > start))
    out: list[int] = []
    for row in hit.orderBy("start").toLocalIterator():
        begin = max(start - row["start"], 0)
        stop = min(start + count - row["start"], row["n_ids"])
        out += grammar_of(row.asDict()).read(begin, stop - begin).tolist()
    return out
