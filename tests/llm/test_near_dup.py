import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from cases import EDGES, documents
from presslake.llm.components import components
from presslake.llm.near_dup import DEPTH, forest_links, ngram_join, prefix_depth

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows, threshold=Fraction(4, 5)):
    sets = {i: shingles(t) for i, t in rows}
    links = defaultdict(set)
    for a, x in sets.items():
        for b, y in sets.items():
            if a != b and x and len(x & y) * threshold.denominator >= len(x | y) * threshold.numerator:
                links[a].add(b)
    out = {}
    for a in sets:
        reached, todo = {a}, [a]
        while todo:
            new = links[todo.pop()] - reached
            reached |= new
            todo += new
        out[a] = (min(reached), len(links[a]))
    return out


def near_copies(seed, docs=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [[word() for _ in range(rng.randint(30, 120))] for _ in range(8)]
    rows = []
    for i in range(docs):
        words = list(rng.choice(base)) if i % 4 else [word() for _ in range(rng.randint(1, 60))]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = word()
        rows.append((i * 2 + 1, " ".join(words) + rng.choice(["", ".", "!!"])))
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_matches_brute_force(spark, block):
    rows = near_copies(block)
    found = ngram_join(documents(spark, rows), block=block).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == brute(rows)


def test_measured_recall_just_above_the_threshold(spark):
    """Pairs of similarity 0.81 to 0.86, the hardest to find, among 600 documents."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    rows = []
    for i in range(300):
        words = [word() for _ in range(200)]
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(10, 190, 10), 3 + i % 2):
            words[at] = word()
        rows.append((2 * i + 1, " ".join(words)))
        alike = [shingles(t) for _, t in rows[-2:]]
        assert 0.8 <= len(alike[0] & alike[1]) / len(alike[0] | alike[1]) < 0.87
    found = ngram_join(documents(spark, rows)).collect()
    assert sum(r.n_links == 1 and r.class_id == r.doc_id // 2 * 2 for r in found) >= 0.99 * 600


def test_edge_rows(spark):
    found = ngram_join(documents(spark, EDGES)).collect()
    assert len(found) == len(EDGES)
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append((r.class_id, r.n_links, r.n_copies))
    assert by_id[None] == [(None, 0, 1), (None, 0, 1)]
    for doc_id in (1, 2, 3, 4, 5, 9, 10):
        assert by_id[doc_id] == [(doc_id, 0, 1)]
    # 6, 7 twice and 8 are copies; the other row 8 is a text of its own under an id of that class.
    assert by_id[6] == [(6, 3, 4)] and by_id[7] == [(6, 3, 4)] * 2
    assert (6, 3, 4) in by_id[8]


def test_empty_table(spark):
    assert ngram_join(documents(spark, [])).count() == 0


def test_prefix_is_shortened_until_the_recall_is_reached():
    depth = prefix_depth(0.8)
    assert 1 - (1 - 0.8**depth) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 32
    assert prefix_depth(0.99) == 8


@pytest.mark.parametrize("tasks", [1, 7])
def test_branches_are_whole_over_any_cut(spark, tasks):
    """Links of depth ``d`` or more connect exactly the paths that share ``d`` values."""
    rng = random.Random(3)
    paths = [bytes([rng.randrange(2)]) + b"".join(bytes([0, rng.random() < 0.2]) for _ in range(DEPTH)) for _ in range(400)]
    paths += [paths[0]] * 300  # one branch is longer than a task's share
    rows = [(i, bytearray(p)) for i, p in enumerate(paths)]
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        members = spark.createDataFrame(rows, "node long, path binary")
        links = [tuple(r) for r in forest_links(members, 1).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(links) < len(paths) + 2 * tasks
    for depth in range(1, DEPTH + 1):
        root = list(range(len(paths)))

        def top(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b, at in links:
            if at >= depth:
                root[max(top(a), top(b))] = min(top(a), top(b))
        first = {}
        for i, p in enumerate(paths):
            assert top(i) == first.setdefault(p[: 1 + 2 * depth], i)


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1080)]
    edges += [(None, 3), (5, 5)]
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    expected = {}
    for node in sorted(near):
        if node not in expected:
            todo = [node]
            while todo:
                at = todo.pop()
                if at not in expected:
                    expected[at] = node
                    todo += near[at]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
