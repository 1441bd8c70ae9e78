import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import EDGES, documents
from presslake.llm import alignment
from presslake.llm.alignment import (
    ByteLevel,
    Pieces,
    align_tokens,
    alignment_digests,
    group_sizes,
    link_counts,
    merge_path,
    overlaps,
    pair_bound,
)
from presslake.llm.queries import QUERIES

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]

ODD = [
    "a <s> </s> <unk> <0x41> <|endoftext|> b",
    "a▁b ▁ c",
    "  two  blanks   three    four ",
    " ",
    "tab\tnew\nline\r\n x\x0b\x1c\x1d \x85 \xa0 y",
    "é ﬁ ① İstanbul ǅ ​ ﻿ zero\x00byte",
    "日本語 のテキスト и кириллица 👩‍👩‍👧 done't we'll  I'M",
    "x" * 5000,
    "　wide　   blanks",
]


def brute(rows):
    """Per document by both libraries on whole texts and a plain walk over the bytes."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    names = {i: t for t, i in a.get_vocab().items()}
    stands = {chr(x): x for x in (*range(33, 127), *range(161, 173), *range(174, 256))}
    rest = [x for x in range(256) if x not in stands.values()]
    stands |= {chr(256 + i): x for i, x in enumerate(rest)}

    def piece(i):
        if b.is_byte(i):
            return bytes([int(b.id_to_piece(i)[3:5], 16)])
        return b.id_to_piece(i).replace("▁", " ").encode()

    found, pairs = [], Counter()
    for doc, text in rows:
        ids = [[], []]
        if text:
            ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
            parts = [[bytes(stands[c] for c in names[i]) for i in ids[0]], [piece(i) for i in ids[1]]]
            if any(b"".join(p) != (" " + text).encode() for p in parts):
                ids = [[], []]
        groups, links = [], []
        if ids[0]:
            x = y = at_a = at_b = 0
            group = ([], [])
            while x < len(ids[0]) or y < len(ids[1]):
                if at_a <= at_b:
                    at_a += len(parts[0][x])
                    group[0].append(ids[0][x])
                    x += 1
                else:
                    at_b += len(parts[1][y])
                    group[1].append(ids[1][y])
                    y += 1
                if at_a == at_b and group[0] and group[1]:
                    groups.append(group)
                    links.append((group[0][-1], group[1][-1]))
                    group = ([], [])
        pairs.update(links)
        spelled = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        found.append((doc, len(ids[0]), len(ids[1]), len(groups), links, spelled))
    top = defaultdict(int)
    for (_, y), n in pairs.items():
        top[y] = max(top[y], n)
    return sorted(
        (doc if doc is not None else -1, n_a, n_b, n, len(links), sum(pairs[l] == top[l[1]] for l in links), sum(pairs[l] for l in links), s)
        for doc, n_a, n_b, n, links, s in found
    ), pairs


def walk(a, b):
    return sorted({*a, *b})


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 4096])
def test_pieces_make_one_merge(piece):
    rng = np.random.default_rng(piece)
    for size in (1, 2, 5, 40, 300):
        for density in (0.05, 0.3, 0.9, 1.0):
            a, b = (np.append(np.flatnonzero(rng.random(size - 1) < density) + 1, size).astype(np.int64) for _ in range(2))
            at_a, at_b, ends = overlaps(a, b, piece)
            assert ends.tolist() == walk(a.tolist(), b.tolist())
            assert at_a.tolist() == np.searchsorted(a, ends).tolist() and at_b.tolist() == np.searchsorted(b, ends).tolist()
            shared = np.intersect1d(a, b)
            in_a, in_b = group_sizes(a, b, piece)
            assert np.cumsum(in_a).tolist() == (np.searchsorted(a, shared) + 1).tolist()
            assert np.cumsum(in_b).tolist() == (np.searchsorted(b, shared) + 1).tolist()
            i, j = merge_path(a, b, piece)
            assert set(np.diff(i + j)[:-1].tolist()) <= {piece}


def test_matches_the_libraries(spark, monkeypatch):
    rng = random.Random(11)
    letters = "aeinst  \n\t.,'’éü日\x1c <>0x1▁"
    rows = [r[:2] for r in EDGES] + [(100 + i, t) for i, t in enumerate(ODD)]
    rows += [(200 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for i in range(300)]
    expected, pairs = brute(rows)
    docs = documents(spark, rows)
    found = alignment_digests(docs, *PATHS)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert sorted(tuple(-1 if c == "doc_id" and r[c] is None else r[c] for c in columns) for r in found.collect()) == expected
    counts = link_counts(align_tokens(docs, *PATHS)).collect()
    assert {(r.a, r.b): r.n for r in counts} == pairs and len(counts) == len(pairs)


def test_runs_are_kept_within_a_limit(monkeypatch):
    texts = [f"word{i} other{i % 7} Word" for i in range(500)]
    whole = alignment.Aligner(*PATHS)
    want = [x.tolist() for x in whole.encode(texts)[0]]
    monkeypatch.setattr(alignment, "KEPT_BYTES", 1600)
    small = alignment.Aligner(*PATHS)
    got = [[], []]
    for t in texts:
        for side, ids in enumerate(small.encode([t])[0]):
            got[side] += ids.tolist()
    assert got == want and small.held <= 1600 and len(small.known) < 20


def test_pairs_are_bounded_by_the_vocabularies():
    a, b = ByteLevel(PATHS[0]), Pieces(PATHS[1])
    bound = pair_bound(*PATHS)
    assert bound <= sum(map(int, a.lengths)) + sum(map(int, b.lengths)) < 1_000_000


def test_empty_table(spark):
    assert alignment_digests(documents(spark, []), *PATHS).count() == 0
    assert alignment_digests(documents(spark, [(1, None), (2, "")]), *PATHS).agg(F.sum("n_a")).first()[0] == 0


def test_query_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    expected = [
        (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "") for row in brute(map(tuple, docs.collect()))[0]
    ]
    found = QUERIES["op12_token_alignment"](spark, sf_dir)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == columns
    assert sorted(map(tuple, found.collect())) == expected


def test_runs_of_several_batches_outlast_the_others(monkeypatch):
    """When the kept runs are full, those seen again stay known, with the same ids; the others go."""
    monkeypatch.setattr(alignment, "KEPT_BYTES", 40 * (alignment.RUN_BYTES + 6))
    small = alignment.Aligner(*PATHS)
    often, learnt = "often seen words stay", []
    monkeypatch.setattr(small, "_learn", lambda runs, learn=small._learn: (learnt.extend(runs), learn(runs)))
    for i in range(30):
        texts = [often, " ".join(f"rare{i}x{j}" for j in range(12)), None, "", "  odd  é ", often]
        ids, counts = small.encode(texts)
        whole = alignment.Aligner(*PATHS).encode(texts) if i % 5 == 4 else (ids, counts)
        for found, wanted in zip([*ids, *counts], [*whole[0], *whole[1]]):
            assert found.tolist() == wanted.tolist()
        assert small.held <= alignment.KEPT_BYTES
    assert all(learnt.count(word) == 1 for word in often.split(" "))
    assert learnt.count("rare3x3") == 1 and "rare3x3" not in small.known
