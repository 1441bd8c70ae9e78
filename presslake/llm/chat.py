"""Chat formatting at token level.

A turn is ``<s>`` role ``[INST]`` text ``[/INST]</s>``. Roles and texts are
escaped and encoded as segments of their own; the control strings are never
encoded but spliced in as reserved ids, so no text can produce one. In the
formatted string a backslash before a control string (or before a backslash) in a
text keeps it apart from the template. Token positions and the loss mask come
from prefix sums over segment lengths.

Turns are dealt out by ranges of conversation and turn, so a conversation of any
length is encoded by many tasks: each counts from the beginning of its range, and
what a conversation has before the range (at most one row a task) is added
afterwards. Decoding is split in any way; only the digests of a conversation run
along its turns in order, one turn in memory at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from presslake.llm.bpe import read_ranks
from presslake.llm.common import worker_cache
from presslake.llm.components import _written

# The control strings, and their ids above the tokenizer's own.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
FIRST_RESERVED = 50257
TURN, END, SAYS, SAID = (FIRST_RESERVED + i for i in (0, 1, 2, 3))

_TO_ESCAPE = re.compile(r"\\|" + "|".join(f"(?={re.escape(c)})" for c in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

TURN_DDL = (
    "conv_id {conv}, seq long, formatted string, ids array<int>, loss array<boolean>, "
    "token_start long, char_start long, token_end long, char_end long, part int"
)
RANGE_CHARS = 64  # of a text, to deal out turns that agree in all else


def escape(text: str) -> str:
    """A backslash before each backslash and each control string."""
    return _TO_ESCAPE.sub(lambda m: "\\\\" if m[0] else "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    return worker_cache(
        f"chat-{path}",
        lambda: tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}),
    )


def format_chats(
    turns: DataFrame,
    path: str,
    pattern: str,
    keys: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
    learned: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row a turn: ``conv_id, seq, formatted, ids, loss, token_start, char_start``.

    The pieces of a conversation in order of ``seq`` are its formatted string, its
    ids and its mask, which is true on the text tokens of ``learned`` roles.
    Null roles and texts are empty; a null ``conv_id`` is a conversation of its
    own. Turns with equal (or null, which come first) numbers go by role, then
    text; repeated rows stay. An empty table gives no rows.
    """
    conv, turn, role, text = keys
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokenizer(path, pattern)
        task = TaskContext.get().partitionId()
        current, seq, tokens, chars = object(), 0, 0, 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                who = [escape(r) for r in part.column("role").to_pylist()]
                what = [escape(t) for t in part.column("text").to_pylist()]
                role_ids, text_ids = encoder.encode_ordinary_batch(who, num_threads=1), encoder.encode_ordinary_batch(what, num_threads=1)
                learn = [r in learned for r in part.column("role").to_pylist()]
                # Prefix sums over the segments TURN role SAYS text SAID END.
                sizes = np.array([(1, len(r), 1, len(t), 1, 1) for r, t in zip(role_ids, text_ids)], np.int64)
                ends = np.cumsum(sizes.ravel()).reshape(sizes.shape)
                ids = np.empty(ends[-1, -1], np.int32)
                for column, reserved in ((0, TURN), (2, SAYS), (4, SAID), (5, END)):
                    ids[ends[:, column] - 1] = reserved
                for row, (r, t) in enumerate(zip(role_ids, text_ids)):
                    ids[ends[row, 0] : ends[row, 1]] = r
                    ids[ends[row, 2] : ends[row, 3]] = t
                change = np.zeros(len(ids) + 1, np.int8)
                np.add.at(change, ends[learn, 2], 1)
                np.add.at(change, ends[learn, 3], -1)
                mask = np.cumsum(change[:-1], dtype=np.int8) > 0
                offsets = pa.array(np.concatenate([[0], ends[:, -1]]).astype(np.int32))
                formatted = [f"<s>{r}[INST]{t}[/INST]</s>" for r, t in zip(who, what)]
                where = []
                for row, conversation in enumerate(part.column("conv_id").to_pylist()):
                    if conversation != current:
                        current, seq, tokens, chars = conversation, 0, 0, 0
                    ends_at = tokens + int(sizes[row].sum()), chars + len(formatted[row])
                    where.append((seq, tokens, chars, *ends_at))
                    seq, (tokens, chars) = seq + 1, ends_at
                numbers = np.array(where, np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("conv_id"),
                        pa.array(numbers[0]),
                        pa.array(formatted, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(ids)),
                        pa.ListArray.from_arrays(offsets, pa.array(mask)),
                        *(pa.array(n) for n in numbers[1:]),
                        pa.array(np.full(part.num_rows, task, np.int32)),
                    ],
                    names=names,
                )

    schema = TURN_DDL.format(conv=rows.schema["conv_id"].dataType.simpleString())
    names = [field.split()[0] for field in schema.split(", ")]
    ranges = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARS))
    ordered = ranges.sortWithinPartitions("conv_id", "turn", "role", "text")
    encoded = _written(ordered.mapInArrow(run, schema), "turns")

    # Only the first conversation of a range can have begun before it: one row a task at most.
    totals = encoded.groupBy("conv_id", "part").agg(
        (F.max("seq") + 1).alias("seq"), F.max("token_end").alias("token"), F.max("char_end").alias("char")
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("conv_id").alias("b_conv"), F.col("part").alias("b_part"), *(F.sum(c).over(before).alias(f"b_{c}") for c in ("seq", "token", "char"))
    ).where("b_seq is not null")
    same = (F.col("part") == F.col("b_part")) & F.col("conv_id").eqNullSafe(F.col("b_conv"))
    moved = {"seq": "seq", "token_start": "token", "char_start": "char"}
    return encoded.join(F.broadcast(bases), same, "left").select(
        *((F.col(c) + F.coalesce(f"b_{moved[c]}", F.lit(0))).alias(c) if c in moved else c for c in names[:-3])
    )


def read_chats(formatted: DataFrame, path: str, pattern: str) -> DataFrame:
    """Read conversations back from ids and masks; one row a conversation.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    Roles and texts are what stands between reserved ids, decoded and unescaped;
    the digests run along the stream, so a conversation of any length takes the
    memory of one turn.
    """

    kind = formatted.schema["conv_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _tokenizer(path, pattern)

        def text(ids: np.ndarray) -> str:
            return unescape(decoder.decode_bytes(ids.tolist()).decode("utf-8"))

        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                said, learned = [], []
                for ids, mask in zip(part.column("ids"), part.column("loss")):
                    ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                    says, end = int(np.flatnonzero(ids == SAYS)[0]), int(np.flatnonzero(ids == SAID)[0])
                    said.append(f"{text(ids[1:says])}\n{text(ids[says + 1 : end])}\n")
                    learned.append(text(ids[mask]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), part.column("seq"), pa.array(said), pa.array(learned), part.column("chars")],
                    names=["conv_id", "seq", "said", "learned", "chars"],
                )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Digest | None = None
        for batch in batches:
            done = []
            for begin in range(0, batch.num_rows, 512):
                columns = batch.slice(begin, 512).to_pydict()
                for conversation, said, learned, chars in zip(*(columns[c] for c in ("conv_id", "said", "learned", "chars"))):
                    if state is None or conversation != state.conv_id:
                        done += [state] if state else []
                        state = _Digest(conversation)
                    state.add(said, learned, chars)
            if done:
                yield _Digest.rows(done, batch.schema.field("conv_id").type)
        if state:
            yield _Digest.rows([state], batch.schema.field("conv_id").type)

    turns = formatted.select("conv_id", "seq", "ids", "loss", F.length("formatted").cast("long").alias("chars"))
    decoded = turns.mapInArrow(decode, f"conv_id {kind}, seq long, said string, learned string, chars long")
    return decoded.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(
        digest,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, said: str, learned: str, chars: int) -> None:
        self.all.update(said.encode())
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.turns += 1
        self.chars += chars

    @staticmethod
    def rows(done: list[_Digest], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d.conv_id for d in done], kind),
                pa.array([d.turns for d in done], pa.int64()),
                pa.array([d.all.hexdigest() for d in done]),
                pa.array([d.loss_chars for d in done], pa.int64()),
                pa.array([d.loss.hexdigest() for d in done]),
                pa.array([d.chars for d in done], pa.int64()),
            ],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )
