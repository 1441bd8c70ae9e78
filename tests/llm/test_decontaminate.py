import random
import re

from pyspark.sql import functions as F

from cases import EDGES, documents
from presslake.llm import decontaminate as module
from presslake.llm.decontaminate import build_index, decontaminate, phrases_of, proximity_matches

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    phrases = []
    for item, text in items:
        w = words(text)
        phrases += [(str(item) if item is not None else "", w[s : s + window]) for s in range(max(len(w) - window, 0) + 1) if w]
    out = []
    for doc, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item, phrase in phrases:
            for s in range(len(w) - len(phrase) + 1):
                if w[s : s + len(phrase)] == phrase:
                    hit.update(range(s, s + len(phrase)))
                    found.add(item)
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontaminate(documents(spark, docs), bench).collect()
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in rows)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=repr)


def random_case(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("Aa bb cc dd É9 the the of".split()) for _ in range(n))
    items = [(i, text(rng.randint(0, 16))) for i in range(12)] + [(3, text(12)), (None, text(11)), (50, "same " * 12)]
    docs = []
    for i in range(40):
        parts = [text(rng.randint(0, 20)), rng.choice(items)[1] if rng.random() < 0.5 else "", text(5)]
        docs.append((i, "; ".join(parts)))
    return [*docs, (90, "same, " * 30), (91, "Same!" * 9)], items


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs, items = random_case(seed)
        assert found(spark, docs, items) == brute(docs, items)


def test_shuffled_lookups_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    docs, items = random_case(3)
    assert found(spark, docs, items) == brute(docs, items)


def test_edge_rows(spark):
    items = [(1, "two three"), (2, None), (3, ""), (4, "...") , (5, "several rows of this table and it is not short"), (6, LONGEST)]
    assert found(spark, EDGES, items) == brute(EDGES, items)


LONGEST = EDGES[12][1][5000:9000]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == []
    assert found(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_proximity(spark):
    docs = documents(spark, [(1, "one alpha x beta two"), (2, "alpha beta"), (3, "alpha a a a a a beta"), (4, "beta alpha")])
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    index = build_index(docs, phrases_of(bench))
    near = proximity_matches(index, 2).select("key.doc_id", "distance").collect()
    assert {(r.doc_id, r.distance) for r in near} == {(1, 1), (2, 0), (4, 2)}


def test_no_python_in_the_plan(spark, capsys):
    docs, items = random_case(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    decontaminate(documents(spark, docs), bench).select(F.col("n_hit")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
