"""Near duplicates by SetSketch registers, banding, joint likelihood and full verification.

A document is its set of ``NGRAM``-word shingles. A register holds the least of the
exponentially distributed hashes of a set, truncated to a power of ``BASE``: the
registers of a union are the larger registers of its parts, and two sets share a
register about as often as they share elements. Sets are equal or hold a pair of
similarity ``threshold`` in some band of ``BAND_ROWS`` registers with probability
0.99998; documents with the same set are one node, handled once.

Nodes that share a band are candidates. How similar two candidates are is estimated
from how many registers are larger, smaller and equal, together with both set sizes,
by maximum likelihood; a pair goes on unless the threshold is far less likely than
the estimate. What is left is compared on the full sets. Three steps keep that small:

1. In each bucket every node is compared with one centre only, and centres with the
   bucket's least node. A bucket has a centre for each of ``SALTS`` shares, so no
   centre is compared with a large part of all nodes.
2. Nodes linked so far form components. A bucket inside one component is done.
3. Buckets that still hold several components are compared across components, in
   blocks: nodes outside the largest component against all. A block is bounded by
   ``BLOCK`` nodes and ``BLOCK_SHINGLES`` shingles, and emits links, never pairs.

All candidate pairs are then either compared or known to be connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import LOWER, flat_text, mix, prefix_hashes, span_hashes, text_slices
from presslake.llm.components import _written, components

NGRAM = 5
THRESHOLD = Fraction(85, 100)
BANDS = 24
BAND_ROWS = 6
REGISTERS = BANDS * BAND_ROWS
# Base, rate and limit of the registers: two bytes hold sets of any size.
BASE = 1.001
RATE = 20.0
LIMIT = (1 << 16) - 1
SALTS = 64
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
UNLIKELY = 14.0  # a pair goes when the threshold is e**-14 times as likely as the estimate

_random = np.random.default_rng(23)
_ODD = 2 * _random.integers(0, 1 << 62, NGRAM + 1).astype(np.uint64) + np.uint64(1)
_FACTORS = _random.integers(0, 1 << 31, (2, REGISTERS)).astype(np.uint32)
_BAND_FACTORS = 2 * _random.integers(0, 1 << 62, BAND_ROWS).astype(np.uint64) + np.uint64(1)

# White space between words: these six bytes, and no others.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the rows, A-Z lower-cased, and the words' row offsets."""
    low = LOWER[data]
    space = np.concatenate([[True], _IS_SPACE[low], [True]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~space[1:-1]
    start = np.flatnonzero(word & (space[:-2] | edge[:-1]))
    end = np.flatnonzero(word & (space[2:] | edge[1:])) + 1
    prefix = prefix_hashes(low.astype(np.uint64) + np.uint64(1))
    return mix(span_hashes(prefix, start, end)), np.searchsorted(start, offsets)


def word_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row and their offsets; fewer than ``NGRAM`` words are one."""
    words, ends = word_hashes(data, offsets)
    sizes = np.diff(ends)
    counts = np.where(sizes >= NGRAM, sizes - NGRAM + 1, sizes > 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.arange(len(owner)) + np.repeat(ends[:-1] - (np.cumsum(counts) - counts), counts)
    padded = np.concatenate([words, np.zeros(NGRAM, np.uint64)])
    total = np.zeros(len(owner), np.uint64)
    for j in range(NGRAM):
        total += np.where(first + j < ends[owner + 1], padded[first + j] * _ODD[j], _ODD[NGRAM])
    shingles = mix(total)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.searchsorted(owner[new], np.arange(len(sizes) + 1))


def _folded(fold, values: np.ndarray, offsets: np.ndarray, empty: int) -> np.ndarray:
    out = np.full(len(offsets) - 1, empty, values.dtype)
    full = offsets[:-1] < offsets[1:]
    if full.any():
        out[full] = fold.reduceat(values, offsets[:-1][full])
    return out


def sketch(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Registers of each set, one row a set; an empty set has all zero."""
    low = shingles.astype(np.uint32)
    least = np.empty((len(offsets) - 1, REGISTERS), np.uint32)
    for r in range(REGISTERS):
        factor, add = _FACTORS[:, r]
        least[:, r] = _folded(np.minimum, low * (factor | np.uint32(1)) + add, offsets, 0)
    hashed = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    registers = np.clip(np.floor(1 - np.log(hashed) / np.log(BASE)), 0, LIMIT).astype(np.uint16)
    registers[offsets[:-1] == offsets[1:]] = 0
    return registers


def merged(parts: np.ndarray) -> np.ndarray:
    """The registers of the union of sets from theirs, one row a part."""
    return parts.max(axis=0)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band; keys of different bands differ."""
    bands = registers.reshape(len(registers), BANDS, BAND_ROWS).astype(np.uint64)
    return mix((bands * _BAND_FACTORS).sum(axis=2, dtype=np.uint64) + mix(np.arange(1, BANDS + 1, dtype=np.uint64)))


def _larger(share: np.ndarray) -> np.ndarray:
    """Chance that a register is larger, given the share of elements that only its set has."""
    return -np.log1p(-share * (BASE - 1) / BASE) / np.log(BASE)


def likely(up: np.ndarray, down: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs may have a similarity of ``threshold``, from their registers and sizes.

    ``up`` and ``down`` count the registers that are larger and smaller on side a. The
    log-likelihood of a similarity is concave, so three-way search finds the estimate.
    """
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)

    def log_likelihood(j):
        tiny = 1e-12
        p, q = _larger(np.maximum(u - v * j, 0)), _larger(np.maximum(v - u * j, 0))
        equal = REGISTERS - up - down
        return (
            up * np.log(np.maximum(p, tiny)) + down * np.log(np.maximum(q, tiny)) + equal * np.log(np.maximum(1 - p - q, tiny))
        )

    low, high = np.zeros_like(most), most.copy()
    for _ in range(30):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        better = log_likelihood(a) < log_likelihood(b)
        low, high = np.where(better, a, low), np.where(better, high, b)
    estimate = (low + high) / 2
    at = np.minimum(threshold, most)
    near = (estimate >= threshold) | (log_likelihood(estimate) - log_likelihood(at) <= UNLIKELY)
    # Sizes alone rule out what they cannot reach; the margin is for rounding only.
    return near & (most >= threshold - 1e-9)


def linked(a: np.ndarray, b: np.ndarray, threshold: Fraction) -> bool:
    """Whether two sorted distinct arrays have a Jaccard similarity of ``threshold`` or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and both * threshold.denominator >= (len(a) + len(b) - both) * threshold.numerator


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        shingles, offsets = word_shingles(*flat_text(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(_folded(np.add, mix(shingles), offsets, 0).view(np.int64)),
                pa.array(_folded(np.add, mix(~shingles), offsets, 0).view(np.int64)),
                _rows(sketch(shingles, offsets)),
            ],
            names=["doc_id", "n", "set_a", "set_b", "registers"],
        )


def _rows(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1] * matrix.itemsize)
    return pa.BinaryArray.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _memberships(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_matrix(batch.column("registers")))
            at = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), batch.column("node").take(at), batch.column("n").take(at)],
                names=["key", "node", "n"],
            )


def _screened(threshold: Fraction):
    """Candidate pairs ``a, b`` with sizes and registers: those the likelihood lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch.column("regs_a")), _matrix(batch.column("regs_b"))
            sizes = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
            keep = likely((x > y).sum(axis=1), (x < y).sum(axis=1), *sizes, float(threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        shingles, offsets = word_shingles(*flat_text(batch.column("text")))
        cells = [None, pa.py_buffer(offsets.astype(np.int64) * 8), pa.py_buffer(shingles)]
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, cells)
        yield pa.RecordBatch.from_arrays([batch.column("node"), held.cast(pa.binary())], names=["node", "shingles"])


def _confirmed(threshold: Fraction):
    """Pairs with both sets: those that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b")))
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold) for x, y in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _candidates(table: pa.Table, threshold: Fraction) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Likely pairs (rows of the table) of a block: left rows against right ones of other components."""
    table = table.combine_chunks()
    left = table.column("left").to_numpy(zero_copy_only=False)
    roots = table.column("root").dictionary_encode().combine_chunks().indices.to_numpy()
    nodes = table.column("node").dictionary_encode().combine_chunks().indices.to_numpy()
    registers, sizes = _matrix(table.column("registers")), table.column("n").to_numpy().astype(float)
    rows, others = np.flatnonzero(left), np.flatnonzero(~left)
    found = []
    for i in rows.tolist():
        # A pair of two left rows meets twice, once from each side; one of them is enough.
        js = others[(roots[others] != roots[i])]
        if len(js):
            up, down = (registers[js] < registers[i]).sum(axis=1), (registers[js] > registers[i]).sum(axis=1)
            js = js[likely(up, down, np.full(len(js), sizes[i]), sizes[js], float(threshold))]
            js = js[nodes[js] != nodes[i]]
            found.append(np.stack([np.full(len(js), i), js]))
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return a, b, table


def _involved(threshold: Fraction):
    def run(table: pa.Table) -> pa.Table:
        a, b, table = _candidates(table, threshold)
        return table.drop_columns(["registers"]).take(pa.array(np.union1d(a, b)))

    return run


def _settled(threshold: Fraction):
    """Links of a block. Rows that the links so far connect are not compared again."""

    def run(table: pa.Table) -> pa.Table:
        a, b, table = _candidates(table, threshold)
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        top = table.column("root").dictionary_encode().combine_chunks().indices.to_numpy().tolist()

        def find(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        first: dict[int, int] = {}
        top = [first.setdefault(root, row) for row, root in enumerate(top)]
        links = []
        for x, y in zip(a.tolist(), b.tolist()):
            if find(x) != find(y) and linked(sets[x], sets[y], threshold):
                top[find(x)] = find(y)
                links.append((x, y))
        at = np.array(links, np.int64).reshape(-1, 2)
        nodes = table.column("node")
        return pa.table({"a": nodes.take(pa.array(at[:, 0])), "b": nodes.take(pa.array(at[:, 1]))})

    return run


def _spread_join(rows: DataFrame, keyed: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keyed`` (one row a key), where a key may have any share of the rows.

    The keyed rows are first copied to the shares of their key that exist, at most
    ``SALTS``; a share is told by ``by``.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    copies = salted.select(*keys, "_salt").distinct().join(keyed, keys)
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: Fraction = THRESHOLD
) -> DataFrame:
    """For each row ``doc_id, n_shingles, component_id, kept``.

    Words are runs of other bytes than blanks and the controls 9 to 13, A-Z
    lower-cased. Two documents are linked if their shingle sets have a Jaccard
    similarity of ``threshold`` or more; ``component_id`` is the least id that links
    lead to, itself included, and ``kept`` says that it is the row's own. Texts that
    are null, empty or without words have no shingles and no links. A row without id
    has no component, is kept and links nobody. Rows that share an id are one node.
    Repeated rows give repeated results; an empty table gives none; other columns
    are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = _written(
        rows.mapInArrow(_sketches, f"doc_id {kind}, n long, set_a long, set_b long, registers binary"), "sketches"
    )
    same = ["n", "set_a", "set_b"]
    classes = _written(
        signed.where("n > 0 and doc_id is not null")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("node"), F.first("registers").alias("registers")),
        "classes",
    )
    members = classes.mapInArrow(_memberships, f"key long, node {kind}, n long")
    members = members.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    shares = members.groupBy("key", "salt").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("many"))
    buckets = shares.groupBy("key").agg(F.min("centre").alias("least"), F.sum("many").alias("size")).where("size > 1")
    shares = shares.join(buckets, "key")
    placed = _written(members.join(shares, ["key", "salt"]), "buckets")

    # Step 1: every node against its centre, every centre against the least node.
    pairs = placed.select(F.col("node").alias("a"), F.col("centre").alias("b")).unionByName(
        placed.select(F.col("centre").alias("a"), F.col("least").alias("b"))
    )
    pairs = pairs.where("a <> b").distinct()
    sketches = classes.select("node", "n", "registers")
    both = pairs
    for side in ("a", "b"):
        own = sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"regs_{side}"))
        both = both.join(own, side)
    pairs = _written(both.mapInArrow(_screened(threshold), f"a {kind}, b {kind}").distinct(), "pairs")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = nodes.distinct()
        texts = rows.join(wanted, rows["doc_id"] == wanted["node"]).select("node", "text")
        return _written(texts.mapInArrow(_sets, f"node {kind}, shingles binary"), "sets")

    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    compared = pairs
    for side in ("a", "b"):
        compared = compared.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    links = _written(compared.mapInArrow(_confirmed(threshold), f"a {kind}, b {kind}"), "links")

    # Step 2: buckets that one component does not fill; a bucket of two has been compared already.
    roots = components(links)
    placed = placed.where("size > 2").select("key", "node", "n").join(roots, "node", "left")
    placed = _written(placed.withColumn("root", F.coalesce("root", "node")), "open-buckets")
    parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("shingles"))
    per_key = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"),
        F.max_by("root", "nodes").alias("major"),
        F.max(F.struct("nodes", "shingles")).alias("most"),
        F.sum("nodes").alias("nodes"),
        F.sum("shingles").alias("shingles"),
    )

    def blocks(nodes, shingles):
        return F.ceil(F.greatest(nodes / F.lit(BLOCK), shingles / F.lit(BLOCK_SHINGLES)))

    open_keys = per_key.where("roots > 1").select(
        "key",
        "major",
        F.greatest(
            blocks(F.col("nodes") - F.col("most.nodes"), F.col("shingles") - F.col("most.shingles")), F.lit(1)
        ).alias("lefts"),
        blocks(F.col("nodes"), F.col("shingles")).alias("rights"),
    )

    # Step 3: blocks of nodes outside the largest component against blocks of all.
    dealt = _spread_join(placed, open_keys, ["key"], "node")
    block = F.xxhash64("node", F.lit(1))
    left = dealt.where(F.col("root") != F.col("major")).select(
        "key", "node", "root", "n", F.lit(True).alias("left"), F.pmod(block, "lefts").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)).alias("j"),
    )
    right = dealt.select(
        "key", "node", "root", "n", F.lit(False).alias("left"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)).alias("i"), F.pmod(block, "rights").alias("j"),
    )
    tasks = left.unionByName(right)
    registers = classes.select("node", "registers")
    row = f"key long, node {kind}, root {kind}, n long, left boolean, i long, j long"
    columns = ["key", "node", "root", "n", "left", "i", "j"]
    involved = _written(
        tasks.join(registers, "node")
        .select(*columns, "registers")
        .groupBy("key", "i", "j")
        .applyInArrow(_involved(threshold), row),
        "involved",
    )
    more = sets_of(involved.select("node"))
    crossed = _written(
        involved.join(registers, "node")
        .join(more, "node")
        .select(*columns, "registers", "shingles")
        .groupBy("key", "i", "j")
        .applyInArrow(_settled(threshold), f"a {kind}, b {kind}"),
        "cross-links",
    )
    # Texts under one id belong together, whatever they say.
    usable = signed.where("n > 0 and doc_id is not null")
    several = usable.groupBy("doc_id").agg(F.min(F.struct(*same)).alias("x"), F.max(F.struct(*same)).alias("y")).where("x <> y")
    named = classes.select(*same, "node")
    owned = usable.join(several.select("doc_id"), "doc_id").join(named, same).select("doc_id", "node")
    shared = owned.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b").distinct()
    roots = components(links.unionByName(crossed).unionByName(shared))

    named = named.join(roots, "node", "left")
    found = _spread_join(signed.select("doc_id", *same), named.select(*same, F.coalesce("root", "node").alias("root")), same, "doc_id", "left")
    found = found.join(roots.select(F.col("node").alias("doc_id"), F.col("root").alias("own")), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("own", "root", "doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
