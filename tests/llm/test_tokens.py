import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cases import EDGES, documents
from presslake.llm import tokens
from presslake.llm.tokens import grammar_of, read_documents, read_range, read_shards, repair, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference(rows):
    tokenizer = Tokenizer.from_file(PATH)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def test_repair_goes_on_until_no_pair_occurs_twice():
    rng = np.random.default_rng(2)
    cases = [rng.integers(0, k, n) for n in (0, 1, 2, 3, 5, 8, 40, 700) for k in (1, 2, 3, 12) for _ in range(6)]
    for ids in cases:
        grammar = repair(ids.astype(np.int32), 12)
        assert grammar.expand(grammar.symbols).tolist() == ids.tolist()
        assert len({tuple(r) for r in grammar.rules.tolist()}) == len(grammar.rules)
        for rule, length in enumerate(grammar.lengths):
            assert len(grammar.expand(np.array([12 + rule], np.int32))) == length
        seen, last = {}, grammar.symbols.tolist()
        for at, pair in enumerate(zip(last, last[1:])):
            assert pair not in seen or seen[pair] == at - 1  # only within three equal symbols
            seen.setdefault(pair, at)


def test_repair_round_trip_and_random_access(monkeypatch):
    monkeypatch.setattr(tokens, "LEAST_COUNT", 3)
    monkeypatch.setattr(tokens, "STRIDE", 7)
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 5, 3000), np.zeros(1000, int), rng.integers(0, 40_000, 500), np.arange(2), np.arange(0)):
        grammar = repair(ids.astype(np.int32), 50_000)
        assert grammar.expand(grammar.symbols).tolist() == ids.tolist()
        for _ in range(40):
            a, n = int(rng.integers(0, len(ids) + 1)), int(rng.integers(0, 60))
            n = min(n, len(ids) - a)
            assert grammar.read(a, n).tolist() == ids[a : a + n].tolist()
    assert len(repair(np.zeros(1000, np.int32), 5).symbols) < 100
    grammar = repair(rng.integers(0, 4, 2000).astype(np.int32), 9)
    assert [len(grammar.expand(np.array([9 + r], np.int32))) for r in range(len(grammar.rules))] == grammar.lengths.tolist()


def test_repair_goes_on_until_no_pair_occurs_twice():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 300, rng.integers(2, 9)) for _ in range(400)]
    texts = [np.concatenate([words[i] for i in rng.integers(0, 400, n)]) for n in (3, 12, 3000)]
    for ids in (*texts, np.array([1, 2, 1, 2]), np.tile([1, 2, 3], 9), np.array([1, 1, 1]), np.repeat([4, 5, 4], 7)):
        grammar = repair(ids.astype(np.int32), 300)
        assert grammar.expand(grammar.symbols).tolist() == ids.tolist()
        last, seen = {}, set()
        for at, pair in enumerate(zip(grammar.symbols[:-1].tolist(), grammar.symbols[1:].tolist())):
            assert pair not in seen or at == last[pair] + 1  # a second place may only overlap the first
            if pair not in seen:
                last[pair] = at
            seen.add(pair)
        assert len(np.unique(grammar.rules, axis=0)) == len(grammar.rules)


def test_shards_hold_what_the_library_encodes(spark, tmp_path):
    rows = [(r[0], r[1]) for r in EDGES if r[0] is not None] + [(20, "Don't <|endoftext|> it'll\u00a0be\t5 Ünḯcodé\x1cx")]
    path = str(tmp_path / "shards")
    write_shards(documents(spark, rows), path, PATH, end=1, shard_ids=100)
    shards = read_shards(spark, path)
    found = sorted(map(tuple, read_documents(shards).collect()), key=lambda r: r[1])
    known = reference(rows)
    assert [r[0] for r in found] == sorted(r[0] for r in rows)
    at = 0
    for doc, start, n, crc in found:
        assert start == at
        assert (n, crc) in {(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in known if i == doc}
        at += n
    assert shards.count() > 2
    flat = [i for r in sorted(shards.collect(), key=lambda r: r["start"]) for i in grammar_of(r.asDict()).expand(grammar_of(r.asDict()).symbols)]
    rng = random.Random(2)
    for _ in range(5):
        a = rng.randint(0, len(flat) - 1)
        assert read_range(shards, a, 50) == flat[a : a + 50]


def test_null_ids_and_empty_table(spark, tmp_path):
    write_shards(documents(spark, [(None, "a"), (2, "b"), (1, None)]), str(tmp_path / "a"), PATH, end=1)
    found = sorted(map(tuple, read_documents(read_shards(spark, str(tmp_path / "a"))).collect()), key=lambda r: r[1])
    assert [(r[0], r[1], r[2]) for r in found] == [(None, 0, 2), (1, 2, 1), (2, 3, 2)]
    write_shards(documents(spark, []), str(tmp_path / "b"), PATH, end=1)
    assert read_documents(read_shards(spark, str(tmp_path / "b"))).count() == 0


def test_words_whose_lower_case_is_longer_and_special_tokens():
    """Letters that lower-case to more than one code point, before every tail, and literals of special tokens."""
    odd = [chr(c) for c in range(0x110000) if chr(c).isalpha() and len(chr(c).lower()) > 1]
    words = [f"{w}{c}" for c in odd for w in ("", "MERKEZ", "a")] + ["MERKEZ\u0130ab", "<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>"]
    texts = [f"{w}{tail} z" for w in words for tail in ("", ".", ",", "!?", ")", " .")]
    tokenizer, codec = Tokenizer.from_file(PATH), tokens.ChunkTokenizer(PATH)
    for text, data in zip(texts, codec.encode(texts, 1)):
        assert np.frombuffer(data, "<u4")[:-1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_are_kept_once_whatever_follows_them():
    codec = tokens.ChunkTokenizer(PATH)
    words = [chr(97 + i) * 3 for i in range(26)]
    codec.encode([" ".join(f"{w}{mark}" for w in words for mark in codec.TAIL)], 1)
    assert len(codec.known) <= len(words) + len(codec.TAIL) + 2


def test_random_chunks_and_forgetting(monkeypatch):
    """Marks, digits and odd letters anywhere, in texts that share chunks, with tables that are often emptied."""
    monkeypatch.setattr(tokens, "CACHED_CHUNKS", 60)
    tokenizer, codec, rng = Tokenizer.from_file(PATH), tokens.ChunkTokenizer(PATH), random.Random(8)
    marks = [*"abzABZ'.,;:!?%$#&*)(\"-019\n\t _", "n't", "'s", "\u0301", "\u0130", "\u00e9", "\u0436", "\u2019", "\u00a0", "\u65e5", "<|endoftext|>"]
    texts = ["", " ", "\n", "\n\n ", "a", "a.", ".a", "'.", "a'."] + ["".join(rng.choices(marks[: rng.choice([31, 60])], k=rng.randint(1, 25))) for _ in range(600)]
    rng.shuffle(texts)
    for at in range(0, len(texts), 20):
        part = texts[at : at + 20]
        for text, data in zip(part, codec.encode(part, 5)):
            assert np.frombuffer(data, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 5], text
    assert codec.encode([], 5) == []


def test_words_met_again_stay_when_the_table_is_full(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_CHUNKS", 60)
    tokenizer, codec, asked = Tokenizer.from_file(PATH), tokens.ChunkTokenizer(PATH), []
    words = codec._words

    def counted(part, library):
        asked.extend(part)
        return words(part, library)

    monkeypatch.setattr(codec, "_words", counted)
    for n in range(40):
        fresh = " ".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + i)}" for i in range(15))
        text = f"Common words, {fresh} known words. 5% c'est"
        assert np.frombuffer(codec.encode([text], 1)[0], "<u4")[:-1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(codec.known) <= 60
    assert asked.count("words") == 1 and asked.count("waaa") == 1


def test_words_of_latin_letters_need_no_normaliser():
    letters = [chr(c) for c in range(0xAA, 0x100) if chr(c).isalpha()]
    texts = [f"{a}, x{a} {a}Zy {a}{b}!" for a in letters for b in ("é", "À", "ß")]
    tokenizer, codec = Tokenizer.from_file(PATH), tokens.ChunkTokenizer(PATH)
    codec.encode([f"a{c}" for c in [*codec.TAIL, ""]], 1)
    codec.tokenizer = None  # only its model is asked from here on
    for text, data in zip(texts, codec.encode(texts, 1)):
        assert np.frombuffer(data, "<u4")[:-1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
