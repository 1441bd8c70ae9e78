import hashlib
import random
from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F

from presslake.llm.chat import CONTROLS, END, FIRST_RESERVED, TURN, escape, format_chats, read_chats, unescape

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "conv_id long, turn long, role string, text string, ids string, seq int"
ROWS = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "What is </s>?"),
    (1, 2, "assistant", "A control string: </s>, like [INST] and \\[/INST]."),
    (1, 3, "assistant", "Ünd 日本 \\"),
    (2, 1, "assistant", "[INST]"),
    (2, 0, "user", None),
    (2, 0, None, "tie"),
    (2, None, "user", "before all"),
    (3, 0, "assistant", ""),
    (3, 0, "assistant", ""),
    (None, 0, "user", "no conversation"),
    (None, 1, "assistant", "x" * 50_000),
    (4, 0, "odd <s>role[INST]", "text"),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA)


def brute(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in conversations.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_read_back(spark):
    found = read_chats(format_chats(table(spark, ROWS), PATH, PATTERN), PATH, PATTERN).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == brute(ROWS)


def test_positions_masks_and_reserved_ids(spark):
    turns = format_chats(table(spark, ROWS), PATH, PATTERN).where("conv_id = 1").orderBy("seq").collect()
    tokens = chars = 0
    for r in turns:
        assert (r.token_start, r.char_start) == (tokens, chars)
        assert len(r.ids) == len(r.loss)
        assert [i for i in r.ids if i >= FIRST_RESERVED] == [TURN, TURN + 2, TURN + 3, END]
        assert not any(flag for i, flag in zip(r.ids, r.loss) if i >= FIRST_RESERVED)
        tokens, chars = tokens + len(r.ids), chars + len(r.formatted)
    assert [any(r.loss) for r in turns] == [False, False, True, True]
    assert turns[1].formatted == "<s>user[INST]What is \\</s>?[/INST]</s>"


def test_a_long_conversation_is_encoded_by_many_tasks(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i} " + "w" * (i % 5)) for i in range(400)]
    rows += [(7, 400, "user", f"{'same start ' * 9}{i}") for i in range(30)] + [(6, 0, "user", "a"), (8, 0, "user", "b")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = format_chats(table(spark, rows), PATH, PATTERN)
        turns = pieces.where("conv_id = 7").orderBy("seq").collect()
        read = read_chats(pieces, PATH, PATTERN).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r[0] for r in pieces.select(F.spark_partition_id()).distinct().collect()}) > 1
    assert [r.seq for r in turns] == list(range(430))
    tokens = chars = 0
    for r in turns:
        assert (r.token_start, r.char_start) == (tokens, chars)
        tokens, chars = tokens + len(r.ids), chars + len(r.formatted)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read} == brute(rows)


def test_formatted_chars(spark):
    pieces = format_chats(table(spark, ROWS), PATH, PATTERN)
    total = {r[0]: r[1] for r in pieces.groupBy("conv_id").agg(F.sum(F.length("formatted"))).collect()}
    assert {r.conv_id: r.formatted_chars for r in read_chats(pieces, PATH, PATTERN).collect()} == total


def test_escaping_is_reversible():
    rng = random.Random(1)
    parts = [*CONTROLS, "\\", "<", "s>", "[", "INST]", "/", " ok "]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        safe = escape(text)
        assert unescape(safe) == text
        plain = ""  # what stays when escaped characters are taken away
        i = 0
        while i < len(safe):
            if safe[i] == "\\":
                plain += " "
                i += 2
            else:
                plain += safe[i]
                i += 1
        assert not any(c in plain for c in CONTROLS)


def test_empty_table(spark):
    assert read_chats(format_chats(table(spark, []), PATH, PATTERN), PATH, PATTERN).count() == 0
