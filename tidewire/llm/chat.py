"""Conversations as training windows of a token budget.

Turns are written as `<|role|>`, line feed, text, `</s>`, line feed. Control strings inside texts and roles
are broken up by a backslash after their first character, and backslashes are doubled, so that a
written window can be read back exactly.

A turn's tokens are those of the turn as written, role line, escapes and `</s>` included; they are counted where the
rows are read, in many tasks. Prefix sums of the turns' tokens choose windows: the system turn (a conversation's first turn, if its
role says so) stands in front of every window, then come the last turns before the window whose texts fit
`history` tokens and that, as written, fit half of `budget`, then as many new turns as fit the rest of `budget`. A window ends between turns; a
turn that alone exceeds the budget gets a window of its own, whole. Only the texts of new assistant turns
are under the loss mask, so each is a target exactly once; repeated turns are context.

Rows of a conversation meet in one task in the order of turns (nulls first, equal turns by role and text) and are
streamed: no more than a few windows are held, however long the conversation, as an empty turn has tokens, too. Null texts and roles are
empty; a null id is a conversation of its own; a repeated row is a turn more. An empty table gives an empty
one. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import ROWS_PER_BATCH, in_batches, texts
from tidewire.llm.pieces import Encoder, Vocabulary

BUDGET = 1024
HISTORY = 256
TARGET_ROLE = "assistant"
# Control strings of this template and of other common ones.
CONTROLS = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
CONTROL_START = re.compile(f"(?=(?:{'|'.join(map(re.escape, CONTROLS))}))(.)", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<\|(.*?)\|>\n(.*?)</s>\n", re.DOTALL)

WINDOWS = "window bigint, text string, new_from bigint, targets array<struct<start: bigint, stop: bigint>>"
ARROW_TARGETS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def escape(text: str) -> str:
    return CONTROL_START.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def written(role: str, text: str) -> tuple[str, str, str]:
    """A turn in the template: head, escaped text, end."""
    return f"<|{escape(role)}|>\n", escape(text), "</s>\n"


class Conversation:
    """Takes turns one by one and gives windows as soon as they are full."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.past: list[tuple] = []
        self.pending: list[tuple] = []
        self.pending_tokens = 0
        self.turns = self.windows = 0

    def push(self, role: str, text: str, tokens: int, of_text: int) -> Iterator[dict]:
        """`tokens` of the turn as written, and `of_text` alone."""
        turn = (role, text, tokens, of_text)
        if not self.turns and role == "system":
            self.system = turn
        self.turns += 1
        self.pending.append(turn)
        self.pending_tokens += tokens
        if self.pending_tokens > 4 * self.budget:
            yield from self._cut(last=False)

    def finish(self) -> Iterator[dict]:
        yield from self._cut(last=True)

    def _cut(self, last: bool) -> Iterator[dict]:
        turns = self.past + self.pending
        sums, said = (np.r_[0, np.cumsum([t[i] for t in turns])] for i in (2, 3))

        def earliest(at: int) -> int:
            """The first of the turns before a place that are its history."""
            return int(max(np.searchsorted(said, said[at] - self.history), np.searchsorted(sums, sums[at] - self.budget // 2)))

        at = len(self.past)
        while at < len(turns):
            started = self.windows > 0
            fixed = self.system[2] if self.system and started else 0
            back = earliest(at) if started else at
            room = self.budget - fixed - (sums[at] - sums[back])
            end = max(at + 1, int(np.searchsorted(sums, sums[at] + room, side="right")) - 1)
            if end >= len(turns) and not last:
                break
            context = ([self.system] if self.system and started else []) + turns[back:at]
            yield self._window(context, turns[at:end])
            at = end
        keep = earliest(at) if self.windows else at
        self.past, self.pending = turns[keep:at], turns[at:]
        if self.past and self.past[0] is self.system:
            self.past = self.past[1:]
        self.pending_tokens = sum(t[2] for t in self.pending)

    def _window(self, context: list[tuple], new: list[tuple]) -> dict:
        # The system turn is in front already; the history doesn't repeat it.
        context = context[:1] + [t for t in context[1:] if t is not self.system]
        out, length, targets, new_from = [], 0, [], 0
        for n, (role, text, *_) in enumerate(context + new):
            if n == len(context):
                new_from = length
            head, body, end = written(role, text)
            if n >= len(context) and role == TARGET_ROLE:
                targets.append({"start": length + len(head), "stop": length + len(head) + len(body)})
            out.append(head + body + end)
            length += len(out[-1])
        self.windows += 1
        return {"window": self.windows - 1, "text": "".join(out), "new_from": new_from, "targets": targets}


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, dict, bool]]:
    """Rows in order with their key; the flag marks the first row of each run of equal keys."""
    previous: object = object()
    for batch in batches:
        for row in batch.to_pylist():
            yield row[key], row, row[key] != previous
            previous = row[key]


def format_windows(
    turns: DataFrame,
    model_path: str,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """One row per window: key, `window` number, `text`, `new_from` and `targets`, in characters of the text."""
    vocabulary = Vocabulary.load(model_path)
    kind = turns.schema[key].dataType.simpleString()

    def count(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        said = texts(batch, "text")
        whole = ["".join(written(r, t)) for r, t in zip(texts(batch, "role"), said, strict=True)]
        for name, turns_ in (("tokens", whole), ("of_text", said)):
            batch = batch.append_column(name, pa.array([len(i) - 2 for i in encoder.encode(turns_)], pa.int64()))
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[dict]:
            conversation, current = None, None
            for name, row, starts in by_key(batches, "key"):
                if starts:
                    if conversation:
                        yield from ({"key": current} | w for w in conversation.finish())
                    conversation, current = Conversation(budget, history), name
                found = conversation.push(row["role"] or "", row["text"] or "", row["tokens"], row["of_text"])
                yield from ({"key": current} | w for w in found)
            if conversation:
                yield from ({"key": current} | w for w in conversation.finish())

        yield from in_chunks(windows(), out)

    out = _arrow_schema(turns, key)
    rows = turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    counted = in_batches(rows, count, f"{schema}, tokens bigint, of_text bigint", vocabulary.prepare)
    ordered = counted.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    return ordered.mapInArrow(run, f"key {kind}, {WINDOWS}").withColumnRenamed("key", key)


def _arrow_schema(frame: DataFrame, key: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema(
        [
            ("key", to_arrow_type(frame.schema[key].dataType)),
            ("window", pa.int64()),
            ("text", pa.string()),
            ("new_from", pa.int64()),
            ("targets", ARROW_TARGETS),
        ]
    )


def in_chunks(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    chunk = []
    for row in rows:
        chunk.append(row)
        if len(chunk) == ROWS_PER_BATCH:
            yield pa.RecordBatch.from_pylist(chunk, schema)
            chunk = []
    if chunk:
        yield pa.RecordBatch.from_pylist(chunk, schema)


def read_back(windows: DataFrame, key: str = "conv_id") -> DataFrame:
    """From written windows alone, one row per conversation: turns, targets and their digests."""
    from pyspark.sql.pandas.types import to_arrow_type

    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    out = pa.schema([("key", to_arrow_type(windows.schema[key].dataType)), *zip(names, kinds, strict=True)])
    kind = windows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[dict]:
            done: Callable[[], dict] | None = None
            for name, row, starts in by_key(batches, "key"):
                if starts:
                    if done:
                        yield done()
                    reader = Reader(name)
                    done = reader.result
                reader.add(row["text"], row["new_from"], row["targets"])
            if done:
                yield done()

        yield from in_chunks(read(), out)

    ordered = (
        windows.withColumnRenamed(key, "key")
        .select("key", "window", "text", "new_from", "targets")
        .repartition("key")
        .sortWithinPartitions("key", "window")
    )
    schema = f"key {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.mapInArrow(run, schema).withColumnRenamed("key", key)


class Reader:
    """Sums up one conversation's windows."""

    def __init__(self, key: object):
        self.key, self.turns, self.chars, self.loss = key, 0, 0, 0
        self.turn_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, new_from: int, targets: list[dict]) -> None:
        self.chars += len(text)
        for role, body in TURN.findall(text, new_from):
            self.turns += 1
            self.turn_digest.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
        for span in targets:
            target = unescape(text[span["start"] : span["stop"]])
            self.loss += len(target)
            self.loss_digest.update(target.encode())

    def result(self) -> dict:
        return {
            "key": self.key,
            "n_turns": self.turns,
            "turns_sha256": self.turn_digest.hexdigest(),
            "loss_chars": self.loss,
            "loss_sha256": self.loss_digest.hexdigest(),
            "formatted_chars": self.chars,
        }
