import hashlib
from collections import defaultdict

from cases import EDGES, documents
from presslake.llm.exact_dedup import exact_dedup

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_matches_brute_force_on_edge_rows(spark):
    found = exact_dedup(documents(spark, EDGES)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == brute(EDGES)


def test_many_copies_of_one_text_are_one_group(spark):
    rows = [(i, "Copy " + "x" * 50 if i % 3 else f"own {i}") for i in range(3000)]
    found = exact_dedup(documents(spark, rows)).where("group_size > 1")
    assert found.count() == 2000
    assert [r.doc_id for r in found.where("kept").collect()] == [2999]


def test_only_ascii_letters_are_folded(spark):
    found = exact_dedup(documents(spark, [(1, "É"), (2, "é"), (3, "E"), (4, "e")]))
    assert {r.doc_id: r.keep_id for r in found.collect()} == {1: 1, 2: 2, 3: 4, 4: 4}


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).count() == 0
