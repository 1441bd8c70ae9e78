import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from cases import EDGES, documents
from presslake.llm import setsketch
from presslake.llm.queries import QUERIES
from presslake.llm.setsketch import (
    BAND_ROWS,
    BANDS,
    REGISTERS,
    band_keys,
    likely,
    linked,
    merged,
    near_duplicates,
    sketch,
    word_shingles,
)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = defaultdict(list)
    for i, t in rows:
        sets[i].append(shingles(t))
    holders = defaultdict(set)
    for i, own in sets.items():
        for s in own:
            for x in s:
                holders[x].add(i)
    near = defaultdict(set)
    for a, own in sets.items():
        for x in own:
            for b in set().union(*(holders[s] for s in x)) if x else ():
                if b != a and any(100 * len(x & y) >= 85 * len(x | y) for y in sets[b]):
                    near[a].add(b)
                    near[b].add(a)
    root = {}
    for a in sorted(sets):
        if a not in root:
            todo = [a]
            while todo:
                at = todo.pop()
                if at not in root:
                    root[at] = a
                    todo += near[at]
    return sorted((i, len(shingles(t)), root[i], root[i] == i) for i, t in rows)


def corpus(seed, docs, edits):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh.,Éx") for _ in range(5))
    base = [[word() for _ in range(rng.randint(30, 160))] for _ in range(6)]
    rows = []
    for i in range(docs):
        words = list(rng.choice(base)) if i % 5 else [word() for _ in range(rng.randint(1, 60))]
        for _ in range(rng.choice(edits)):
            at = rng.randrange(len(words))
            words[at] = rng.choice([word(), words[at].upper()])
        rows.append((3 * i + 1, rng.choice([" ", "\n", "\t \x0b"]).join(words) + rng.choice(["", " \r\n"])))
    rng.shuffle(rows)
    return rows


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()))


@pytest.mark.parametrize("edits", [[0, 1, 2], [1, 2, 3, 4, 5, 6]])
def test_matches_brute_force(spark, edits):
    rows = corpus(len(edits), 400, edits)
    assert found(near_duplicates(documents(spark, rows))) == brute(rows)


def test_small_blocks_and_one_share(spark, monkeypatch):
    """Chains and template families: many components in one bucket, over many blocks."""
    monkeypatch.setattr(setsketch, "BLOCK", 5)
    monkeypatch.setattr(setsketch, "SALTS", 1)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):  # each differs from the one before by one more word at the end
        rows.append((1000 - i, " ".join(words[: 100 - i] + [f"x{k}" for k in range(i)])))
    for i in range(120):
        own = list(words)
        for k in rng.sample(range(100), 2 + i % 3):
            own[k] = f"t{i}-{k}"
        rows.append((2000 + i, " ".join(own)))
    assert found(near_duplicates(documents(spark, rows))) == brute(rows)


def test_edge_rows(spark):
    result = near_duplicates(documents(spark, EDGES)).collect()
    assert len(result) == len(EDGES)
    known = [r[:2] for r in EDGES if r[0] is not None]
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in result if r.doc_id is not None) == brute(known)
    assert [r.component_id for r in result if r.doc_id is None] == [None, None]
    assert all(r.kept for r in result if r.doc_id is None)
    assert near_duplicates(documents(spark, [])).count() == 0


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_registers_merge_and_estimate():
    words = [f"w{i}" for i in range(4000)]
    whole, parts = " ".join(words), [" ".join(words[:2004]), " ".join(words[2000:])]
    rows = sketch(*word_shingles(*flat([whole, *parts])))
    assert (merged(rows[1:]) == rows[0]).all()
    assert (sketch(*word_shingles(*flat([""])))[0] == 0).all()


def test_recall_at_the_threshold():
    """Pairs just above the threshold: measured, not computed. All bands and the likelihood together."""
    rng = np.random.default_rng(9)
    met = pairs = 0
    for _ in range(400):
        n = int(rng.integers(40, 2000))
        common = int(np.ceil(0.85 * n))
        pool = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        extra = n - common
        cut = int(rng.integers(0, extra + 1))
        a, b = np.unique(np.concatenate([pool[:common], pool[common : common + cut]])), np.unique(np.concatenate([pool[:common], pool[common + cut :]]))
        assert linked(a, b, Fraction(85, 100))
        rows = sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        x, y = rows.astype(int)
        ok = likely(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([len(a)]), np.array([len(b)]), 0.85)[0]
        keys = band_keys(rows)
        pairs += 1
        met += bool(ok and (keys[0] == keys[1]).any())
    assert met >= pairs - 1
    assert 1 - (1 - 0.85**BAND_ROWS) ** BANDS > 0.9999 and REGISTERS == BANDS * BAND_ROWS


def test_unlikely_pairs_go():
    rng = np.random.default_rng(10)
    kept = 0
    for _ in range(200):
        common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (500, 500, 500))
        rows = sketch(np.concatenate([np.sort(np.append(common, a)), np.sort(np.append(common, b))]), np.array([0, 1000, 2000])).astype(int)
        x, y = rows
        one = np.array([1000])
        kept += int(likely(np.array([(x > y).sum()]), np.array([(x < y).sum()]), one, one, 0.85)[0])
    assert kept == 0


def test_query_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op11_setsketch"](spark, sf_dir)) == brute(rows)
