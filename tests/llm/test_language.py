import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from cases import EDGES, documents
from presslake.llm import language
from presslake.llm.common import flat_text
from presslake.llm.language import ORDER, code_lengths, fit_language_model, score_languages


def tree(texts):
    counts = [defaultdict(Counter) for _ in range(ORDER + 1)]
    for text in texts:
        data = bytes(ORDER) + text.encode()
        for i in range(ORDER, len(data)):
            for order in range(ORDER + 1):
                counts[order][data[i - order : i]][data[i]] += 1
    return counts


def bits(counts, text):
    data, total = bytes(ORDER) + text.encode(), 0.0
    for i in range(ORDER, len(data)):
        for order in range(ORDER, -1, -1):
            seen = counts[order].get(data[i - order : i])
            if seen:
                whole = sum(seen.values()) + len(seen)
                if data[i] in seen:
                    total -= math.log2(seen[data[i]] / whole)
                    break
                total -= math.log2(len(seen) / whole)
        else:
            total += 8
    return total


def train_rows(seed=1, n=40):
    rng = random.Random(seed)
    words = {"aa": ["anna", "banan", "ab", "nab"], "bb": ["ötö", "töst", "ost", "sto"], "cc": ["kik", "iki", "ikk", "ki"]}
    return [
        (i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 30))), lang)
        for i, lang in enumerate(rng.choice(list(words)) for _ in range(n))
    ]


def test_code_lengths_are_those_of_the_context_tree(spark, monkeypatch):
    monkeypatch.setattr(language, "PIECE", 37)  # texts are cut into pieces
    rows = train_rows()
    model = fit_language_model(documents(spark, rows))
    assert model.languages == ["aa", "bb", "cc"]
    texts = [r[1] for r in train_rows(2, 10)] + ["", "x", "ab ötö \x00 kik", "日本"]
    found = code_lengths(model, *flat_text(pa.array(texts)))
    # Equal texts teach once.
    trees = [tree({t for _, t, lang in rows if lang == name}) for name in model.languages]
    expected = [[bits(t, text) for t in trees] for text in texts]
    assert np.allclose(found, expected, rtol=1e-5, atol=1e-3)


def test_languages_are_told_apart(spark):
    model = fit_language_model(documents(spark, train_rows()))
    held = train_rows(9, 60)
    found = {r.doc_id: r for r in score_languages(documents(spark, held), model).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in held)
    assert all(0.5 < r.score <= 1 for r in found.values())


def test_edge_rows(spark):
    model = fit_language_model(documents(spark, train_rows()))
    found = score_languages(documents(spark, EDGES), model).collect()
    assert len(found) == len(EDGES)
    by_id = {r.doc_id: r for r in found}
    for doc_id in (1, 2, 3, 4):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert all(r.lang_pred != "und" for r in found if r.doc_id in (5, 9, 10))


def test_nothing_learnt_and_empty_table(spark):
    model = fit_language_model(documents(spark, [(1, "text", None), (2, None, "en")]))
    assert model.languages == []
    assert {r.lang_pred for r in score_languages(documents(spark, EDGES), model).collect()} == {"und"}
    assert score_languages(documents(spark, []), model).count() == 0


def test_sample_is_bounded(spark):
    model = fit_language_model(documents(spark, [(i, f"text {i}", "en") for i in range(300)]), per_language=5)
    whole = fit_language_model(documents(spark, [(i, f"text {i}", "en") for i in range(300)]))
    assert len(model.costs[3].rows) < len(whole.costs[3].rows)
