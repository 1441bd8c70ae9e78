import random
import tracemalloc

import numpy as np
import pyarrow as pa

from cases import EDGES, documents
from presslake.llm import toxicity
from presslake.llm.common import flat_text
from presslake.llm.toxicity import SIZES, FILTERS, fit_toxicity, language_thresholds, score_toxicity, word_buckets

BAD = ["grob", "fies", "übel", "mies"]


def corpus(seed, n=600):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = [rng.choice(words) for _ in range(rng.randint(5, 150))]
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text).capitalize() + ".", "en" if i % 2 else "de"))
        labels.append((i, int(toxic)))
    return rows, labels


def fitted(spark, rows, labels):
    return fit_toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, label int"))


def test_held_out_texts(spark):
    model = fitted(spark, *corpus(1))
    rows, labels = corpus(2, 300)
    found = {r.doc_id: r.score for r in score_toxicity(documents(spark, rows), model).collect()}
    assert np.mean([(found[i] >= 0.3) == bool(label) for i, label in labels]) > 0.97


def test_scores_of_pieces_are_those_of_whole_texts(spark, monkeypatch):
    model = fitted(spark, *corpus(1, 120))
    words, offsets = word_buckets(*flat_text(pa.array([r[1] for r in corpus(3, 60)[0]] + ["", "x", "a b"])))
    whole = model.scores(words, offsets)
    monkeypatch.setattr(toxicity, "PIECE", 13)
    assert np.allclose(whole, model.scores(words, offsets))


def test_scores_are_those_of_a_plain_network(spark):
    """Word by word and filter by filter, with loops instead of matrices."""
    model = fitted(spark, *corpus(1, 120))
    texts = [r[1] for r in corpus(3, 12)[0]] + ["", "x", "a b", "!!!", "Übel ÜBEL grob-mies"]
    found = model.scores(*word_buckets(*flat_text(pa.array(texts))))
    for text, score in zip(texts, found):
        buckets, _ = word_buckets(*flat_text(pa.array([text])))
        words = [sum(model.table[slot][row] for slot, row in enumerate(word)) for word in buckets.T]
        total = model.offset
        for i, size in enumerate(SIZES):
            for f in range(FILTERS):
                best = 0.0
                for at in range(len(words) - size + 1):
                    response = sum(words[at + j] @ model.kernel[size][j][:, f] for j in range(size))
                    best = max(best, response + model.bias[i * FILTERS + f])
                total += best * model.weight[i * FILTERS + f]
        assert abs(score - 1 / (1 + np.exp(-(model.scale * total + model.shift)))) < 1e-4


def test_word_buckets():
    """Case and place do not matter; forms of a word share the buckets of their beginnings or endings."""
    buckets, offsets = word_buckets(*flat_text(pa.array(["Grobian, grobian", None, "grobiane vergrobian"])))
    assert offsets.tolist() == [0, 2, 2, 4]
    one, again, longer, prefixed = buckets.T.tolist()
    assert one == again
    assert [a == b for a, b in zip(one, longer)] == [False, True, True, True, False, False, False]
    assert [a == b for a, b in zip(one, prefixed)] == [False, False, False, False, True, True, False]


def test_sample_of_many_chunks():
    """The driver's matrix is filled slice by slice and is that of all texts at once."""
    texts = [r[1] for r in corpus(3, 50)[0]] + [None, "", "x", "!!!", "Übel ÜBEL grob-mies", "a b c d e f g"]
    chunks = pa.chunked_array([texts[:20], [], texts[20:51], texts[51:]], pa.string())
    for table in (chunks, chunks.slice(7), chunks.slice(0, 0), pa.chunked_array([], pa.string())):
        buckets, offsets = toxicity._bucketed(table)
        whole, ends = word_buckets(*flat_text(pa.array(table.to_pylist(), pa.string())))
        assert buckets.tolist() == whole.tolist() and offsets.tolist() == ends.tolist()


def test_training_does_not_copy_its_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 1 << 8)
    monkeypatch.setattr(toxicity, "PIECE", 1 << 10)
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    rng = np.random.default_rng(5)
    buckets = rng.integers(0, 1 << 8, (toxicity.SLOTS, 400_000), np.int32)
    offsets, labels = np.arange(0, 400_001, 100), np.arange(4000.0) % 2
    tracemalloc.start()
    toxicity.train_cnn(buckets, offsets, labels, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 0.8 * buckets.nbytes  # the texts that calibrate are a fifth


def test_unseen_forms_of_known_words(spark):
    """Each toxic text holds other forms of a family; those of the tested texts were never trained on."""
    rng = random.Random(4)

    def text(toxic, forms):
        words = ["w%d" % rng.randrange(300) for _ in range(rng.randint(20, 60))]
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), "schurk" + rng.choice(forms))
        return " ".join(words)

    seen, unseen = [f"e{c}" for c in "abcdefghijklm"], [f"e{c}" for c in "nopqrstuvwxyz"]
    model = fitted(spark, [(i, text(i % 8 == 0, seen)) for i in range(600)], [(i, int(i % 8 == 0)) for i in range(600)])
    found = score_toxicity(documents(spark, [(i, text(i % 2, unseen)) for i in range(100)]), model).collect()
    assert np.mean([(r.score >= 0.3) == bool(r.doc_id % 2) for r in found]) > 0.95

    # Forms that share only their first six bytes come before clean texts, not over 0.3.
    far = [f"i{c}" for c in "nopqrstuvwxyz"]
    found = score_toxicity(documents(spark, [(i, text(i % 2, far)) for i in range(100)]), model).collect()
    assert min(r.score for r in found if r.doc_id % 2) > max(r.score for r in found if not r.doc_id % 2)


def test_edge_rows(spark):
    model = fitted(spark, *corpus(1, 240))
    found = score_toxicity(documents(spark, EDGES), model, keep=("lang", "n_chars")).collect()
    assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
    wordless = {r.score for r in found if r.doc_id in (1, 2, 3)}
    assert len(wordless) == 1 and wordless.pop() < 0.3
    assert score_toxicity(documents(spark, []), model).count() == 0


def test_one_label_or_none(spark):
    rows = [(1, "a b"), (2, "c d")]
    assert {r.score < 0.01 for r in score_toxicity(documents(spark, rows), fitted(spark, rows, [(1, 0), (2, 0)])).collect()} == {True}
    nothing = fitted(spark, rows, [(1, None), (9, 1)])
    assert {r.score for r in score_toxicity(documents(spark, rows), nothing).collect()} == {0.5}


def test_thresholds(spark):
    rows = [("en", s / 10, int(s > 6)) for s in range(10)] + [("fr", 0.2, 0), ("de", 0.1, 1), ("de", 0.9, 0), (None, 0.5, 1)]
    found = language_thresholds(spark.createDataFrame(rows, "lang string, score double, label int")).collect()
    assert {r.lang: round(r.threshold, 3) for r in found} == {"en": 0.7, "fr": 1.0, "de": 0.1}
