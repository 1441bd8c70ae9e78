"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

A document is its set of ``NGRAM``-word shingles. Documents with the same set form
a copy class that is handled once, by its representative. A forest of ``TREES``
tries indexes the representatives: the path of a document in a tree is a list of
``DEPTH`` MinHash values. A trie is stored as its sorted paths: the values that
neighbours share are the depth of the branch between them, so one sort serves all
prefix lengths. Matched prefixes are shortened from full depth, level by level,
until a pair at the similarity threshold, the hardest there is, meets in some tree
with probability ``recall`` at least; the level follows from the threshold, the
number of trees and the recall asked for, never from a count of candidates.

A branch of any size links each member to its first one only, so branches cost as
many rows as members, and a large one is sorted by many tasks. Connected candidates
are then compared exactly: each candidate component is dealt out as pairs of blocks of bounded size, and every
pair of sets in two blocks is intersected there, by a matrix product over the
shingles that occur twice. Pairs are counted, never emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import flat_text, hashed_words, mix, text_slices
from presslake.llm.components import _written, components

NGRAM = 5
THRESHOLD = Fraction(4, 5)
TREES = 32
DEPTH = 8
RECALL = 0.9999
BLOCK = 256
SHINGLE_COLUMNS = 8192
PATH_BYTES = 1 + 2 * DEPTH  # the tree, then two bytes of each MinHash value

_ODD = np.array([2 * int(x) + 1 for x in np.random.default_rng(5).integers(0, 1 << 62, NGRAM + 1)], np.uint64)
_FACTORS = np.random.default_rng(17).integers(0, 1 << 31, (2, TREES * DEPTH)).astype(np.uint32)


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Shorten prefixes from full depth until a pair of similarity ``threshold`` shares one in some tree with probability ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row and their offsets; fewer than ``NGRAM`` words are one shingle."""
    words, ends = hashed_words(data, offsets)
    sizes = np.diff(ends)
    starts = np.maximum(sizes - NGRAM + 1, (sizes > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(sizes)), starts)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts) + ends[:-1][owner]
    total = np.zeros(len(owner), np.uint64)
    padded = np.concatenate([words, np.zeros(NGRAM, np.uint64)])
    for j in range(NGRAM):
        inside = first + j < ends[1:][owner]
        total += np.where(inside, padded[first + j] * _ODD[j], _ODD[NGRAM])
    shingles = mix(total)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    keep = np.ones(len(shingles), bool)
    keep[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[keep], owner[keep]
    return shingles, np.searchsorted(owner, np.arange(len(sizes) + 1))


def _sums(values: np.ndarray, offsets: np.ndarray, fold, empty: int) -> np.ndarray:
    out = np.full(len(offsets) - 1, empty, values.dtype)
    full = offsets[:-1] < offsets[1:]
    if full.any():
        out[full] = fold.reduceat(values, offsets[:-1][full])
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        shingles, offsets = shingle_sets(*flat_text(batch.column("text")))
        low = shingles.astype(np.uint32)
        paths = np.zeros((len(offsets) - 1, TREES, PATH_BYTES), np.uint8)
        for tree in range(TREES):
            paths[:, tree, 0] = tree
            for level in range(DEPTH):
                factor, add = _FACTORS[:, tree * DEPTH + level]
                least = mix(_sums(low * (factor | np.uint32(1)) + add, offsets, np.minimum, 0))
                paths[:, tree, 1 + 2 * level] = (least >> np.uint64(8)) & np.uint64(255)
                paths[:, tree, 2 + 2 * level] = least & np.uint64(255)
        count = len(paths) * TREES
        ends = np.arange(count + 1, dtype=np.int32)
        cells = pa.BinaryArray.from_buffers(
            pa.binary(), count, [None, pa.py_buffer(ends * np.int32(PATH_BYTES)), pa.py_buffer(paths)]
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(_sums(mix(shingles), offsets, np.add, 0).view(np.int64)),
                pa.array(_sums(mix(~shingles), offsets, np.add, 0).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends[::TREES]), cells),
            ],
            names=["doc_id", "n", "set_a", "set_b", "paths"],
        )


def shared_depths(paths: np.ndarray) -> np.ndarray:
    """How many MinHash values each sorted path shares with the one before it; -1 for the first."""
    differ = paths[1:] != paths[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), PATH_BYTES)
    return np.concatenate([[-1], np.maximum(first - 1, 0) // 2])[: len(paths)]


def _branches(least_depth: int, ends: bool):
    """Link each path of a sorted partition to the first path of the deepest branch it continues.

    All members of a branch at any depth are then connected by links of that depth
    or more. With ``ends``, the first and last path of the partition come out too.
    """

    def edge(paths: np.ndarray, nodes: pa.Array, row: int) -> pa.RecordBatch:
        node = nodes.slice(row, 1)
        path = pa.array([paths[row].tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([node, node, pa.array([0], pa.int32()), path], names=["a", "b", "depth", "path"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column, nodes = batch.column("path").cast(pa.large_binary()), batch.column("node")
            begin = column.offset * PATH_BYTES
            flat = np.frombuffer(column.buffers()[2], np.uint8)[begin : begin + len(column) * PATH_BYTES]
            paths = flat.reshape(-1, PATH_BYTES)
            if last is None:
                depths = shared_depths(paths)
                firsts = pa.concat_arrays([nodes.slice(0, 1)] * (DEPTH + 1))
                if ends:
                    yield edge(paths, nodes, 0)
            else:
                depths = shared_depths(np.concatenate([last, paths]))[1:]
            # The first path of the open branch at each depth, then the rows of the batch.
            known = pa.concat_arrays([firsts, nodes])
            rows = np.arange(len(paths)) + DEPTH + 1
            opened = np.stack(
                [np.maximum.accumulate(np.where(depths < d, rows, d)) for d in range(DEPTH + 1)]
            )
            hit = np.flatnonzero(depths >= least_depth)
            yield pa.RecordBatch.from_arrays(
                [
                    nodes.take(pa.array(hit)),
                    known.take(pa.array(opened[depths[hit], hit])),
                    pa.array(depths[hit], pa.int32()),
                    pa.nulls(len(hit), pa.binary()),
                ],
                names=["a", "b", "depth", "path"],
            )
            firsts, last = known.take(pa.array(opened[:, -1])), paths[-1:].copy()
        if ends and last is not None:
            yield edge(paths, nodes, -1 + len(paths))

    return run


def forest_links(members: DataFrame, least_depth: int) -> DataFrame:
    """Links ``a, b, depth`` between the ``node`` of paths that share ``depth >= least_depth`` values.

    Two nodes share a prefix of some length in a tree exactly if links of that depth
    or more connect them there. ``members (node, path)`` are sorted over all tasks,
    by path and node, so that a branch of any size is split; the first and last path
    of each sorted partition (two rows a task) join what a cut separates.
    """
    kind = members.schema["node"].dataType.simpleString()
    schema = f"a {kind}, b {kind}, depth int, path binary"
    in_order = members.repartitionByRange("path", "node").sortWithinPartitions("path", "node")
    found = _written(in_order.mapInArrow(_branches(least_depth, True), schema), "forest")
    cuts = found.where("path is not null").select(F.col("a").alias("node"), "path")
    seams = cuts.repartition(1).sortWithinPartitions("path", "node").mapInArrow(_branches(least_depth, False), schema)
    return found.where("path is null").unionByName(seams).select("a", "b", "depth").where("a <> b")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        shingles, offsets = shingle_sets(*flat_text(batch.column("text")))
        cells = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), batch.num_rows, [None, pa.py_buffer(offsets.astype(np.int64) * 8), pa.py_buffer(shingles)]
        )
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in batch.schema.names if c != "text"], cells.cast(pa.binary())],
            names=[*[c for c in batch.schema.names if c != "text"], "shingles"],
        )


def similar_pairs(sets: list[np.ndarray], threshold: Fraction = THRESHOLD) -> np.ndarray:
    """Which of the sets (sorted distinct arrays) have a Jaccard similarity of ``threshold`` or more."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, kind, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[kind]
    owner, kind = owner[keep], column[kind[keep]]
    order = np.argsort(kind, kind="stable")
    owner, kind = owner[order], kind[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, int(shared.sum()), SHINGLE_COLUMNS):
        a, b = np.searchsorted(kind, [begin, begin + SHINGLE_COLUMNS])
        rows = np.zeros((len(sets), min(SHINGLE_COLUMNS, int(shared.sum()) - begin)), np.float32)
        rows[owner[a:b], kind[a:b] - begin] = 1
        common += rows @ rows.T
    both = np.rint(common).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    linked = both * threshold.denominator >= union * threshold.numerator
    linked &= (sizes > 0)[:, None] & (sizes > 0)[None, :]
    np.fill_diagonal(linked, False)
    return linked


def _verify(threshold: Fraction):
    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        nodes = table.column("node").to_pylist()
        block, copies = table.column("block").to_numpy(), table.column("copies").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        linked = similar_pairs(sets, threshold)
        if low != high:  # pairs inside one block belong to another task
            linked &= block[:, None] != block[None, :]
        links = linked @ copies
        label = np.arange(len(nodes))
        while True:  # least row reached, over the links of this task
            near = np.where(linked, label[None, :], len(nodes)).min(axis=1, initial=len(nodes))
            new = np.minimum(label, near)
            new = new[new]
            if (new == label).all():
                break
            label = new
        hit = np.flatnonzero(links > 0)
        return pa.table(
            {
                "node": pa.array([nodes[i] for i in hit], table.schema.field("node").type),
                "other": pa.array([nodes[label[i]] for i in hit], table.schema.field("node").type),
                "links": pa.array(links[hit], pa.int64()),
            }
        )

    return run


def ngram_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: Fraction = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """For each row ``doc_id, class_id, n_links, n_copies``.

    Two documents are linked if the Jaccard similarity of their shingle sets is at
    least ``threshold``; copies (equal sets) are linked. ``n_links`` counts the
    documents linked with this one, ``n_copies`` those with an equal set
    (including itself). ``class_id`` is the least id that is connected with it.
    Null, empty and wordless texts have no links and are classes of their own. A
    row without id has no class and no links, and counts for nobody. Rows that
    share an id are one node of the graph. An empty table gives no rows.
    """
    depth = prefix_depth(float(threshold), recall=recall)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = _written(
        rows.mapInArrow(_signatures, f"doc_id {kind}, n long, set_a long, set_b long, paths array<binary>"),
        "signatures",
    )
    same = ["n", "set_a", "set_b"]
    usable = signed.where("n > 0 and doc_id is not null")
    classes = usable.groupBy(*same).agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("paths").alias("paths")
    )
    classes = _written(classes, "classes")

    near = forest_links(classes.select("node", F.explode("paths").alias("path")), depth).select("a", "b")
    candidates = _written(components(near), "candidates")

    # Blocks: as many as keep each at about ``block`` sets; every pair of blocks meets once.
    sizes = candidates.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    placed = (
        candidates.join(sizes, "root")
        .join(classes.groupBy("node").agg(F.sum("copies").alias("copies")), "node")
        .select("node", "root", "copies", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    )
    placed = _written(placed, "placed")  # of known size: Spark broadcasts it only where it is small
    found = rows.join(placed, rows["doc_id"] == placed["node"]).select("node", "root", "copies", "blocks", "block", "text")
    sets = found.mapInArrow(
        _sets, f"node {kind}, root {kind}, copies long, blocks long, block long, shingles binary"
    ).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    checked = (
        sets.withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("node", "root", "copies", "block", "low", "high", "shingles")
        .groupBy("root", "low", "high")
        .applyInArrow(_verify(threshold), f"node {kind}, other {kind}, links long")
    )
    checked = _written(checked, "links")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("node").alias("a"), F.col("other").alias("b")))
    per_node = links.join(roots, "node")

    by_class = classes.select(*same, "node", "copies").join(per_node, "node", "left")
    joined = signed.select("doc_id", *same).join(by_class, same, "left")
    counted = F.col("doc_id").isNotNull()
    return joined.select(
        "doc_id",
        F.when(counted, F.coalesce("root", "node", "doc_id")).alias("class_id"),
        F.when(counted, F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1)
        .otherwise(0)
        .cast("long")
        .alias("n_links"),
        F.when(counted, F.coalesce("copies", F.lit(1))).otherwise(1).cast("long").alias("n_copies"),
    )
