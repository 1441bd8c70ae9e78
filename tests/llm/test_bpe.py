import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from cases import EDGES, documents
from presslake.llm.bpe import TreeBPE, bpe_decode, bpe_encode, read_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def both():
    ranks = read_ranks(PATH)
    return TreeBPE(ranks, PATTERN), tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(both):
    tree, known = both
    rng = random.Random(3)
    alphabets = ["ab", "the andio ", "aAzZ09 .,'\n\t", "éüß ñ日本🙂 x", " \n\t\u00a0\u2003", "'sre t'll", "=-_/#*", "a\x1c\x1d\x1e\x1f\x85\x0b\x0c 's"]
    for _ in range(1500):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 90)))
        ids = tree.encode(text)
        assert ids == known.encode_ordinary(text), text
        assert tree.decode(ids) == text.encode()


def test_long_pieces(both):
    tree, known = both
    rng = random.Random(4)
    texts = ["a" * 5001, "x" + "a" * 4097, " " * 3333 + "b", "ab" * 2500, "=" * 1025, "é" * 1500]
    texts += ["".join(rng.choice("abcdeto") for _ in range(4000)) for _ in range(3)]
    for text in texts:
        assert tree.encode(text) == known.encode_ordinary(text)


def test_joins_of_any_two_halves(both):
    tree, _ = both
    rng = random.Random(5)
    for _ in range(400):
        data = bytes(rng.choice(b"theandio s") for _ in range(rng.randint(2, 60)))
        cut = rng.randint(1, len(data) - 1)
        assert tree.join(tree.merge(data[:cut]), tree.merge(data[cut:])) == tree.merge(data)


def test_edge_rows(spark, both):
    _, known = both
    out = bpe_decode(bpe_encode(documents(spark, EDGES), PATH, PATTERN), PATH, PATTERN).collect()
    expected = sorted(
        (repr(i), known.encode_ordinary(t or ""), hashlib.md5((t or "").encode()).hexdigest()) for i, t, *_ in EDGES
    )
    assert sorted((repr(r.doc_id), list(r.ids), hashlib.md5(bytes(r.decoded)).hexdigest()) for r in out) == expected


def test_empty_table(spark):
    assert bpe_decode(bpe_encode(documents(spark, []), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_short_merges_equal_the_queue(both):
    tree, known = both
    rng = random.Random(6)
    for _ in range(3000):
        data = bytes(rng.choice(b"theandios \xc3\xa9=") for _ in range(rng.randint(1, 30)))
        assert tree.merge_short(data) == tree.merge(data)
    assert [tree.encode("=" * n) for n in (23, 24, 25, 49)] == [known.encode_ordinary("=" * n) for n in (23, 24, 25, 49)]
    assert all(len(piece) <= 40 for piece in tree.pieces)  # long ones are not kept


def test_tokens_are_gathered_for_many_rows_at_once(spark, both):
    """Rows of one batch share a buffer; rows without ids take nothing from it."""
    _, known = both
    rows = [(1, "", "", "", 0), (2, None, "", "", 0), (3, "", "", "", 0)]
    more = [(i, None if i % 5 == 0 else "日本 é" * (i % 4) + f" word{i}", "", "", 0) for i in range(700)]
    for some in (rows, more):
        out = bpe_decode(bpe_encode(documents(spark, some).coalesce(1), PATH, PATTERN), PATH, PATTERN).collect()
        assert sorted((r.doc_id, list(r.ids), bytes(r.decoded)) for r in out) == [
            (i, known.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in some
        ]
    tree, _ = both
    with pytest.raises(LookupError):
        tree.decode([len(tree.spelled)])
