"""Chat formatting: one training example for every assistant turn, with all earlier turns as its context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick

# The template: <|start|>role<|text|>text<|end|> per turn. Escaped texts hold none of these strings, nor [INST], [/INST], <s>, </s>.
START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
TRAINED = "assistant"

_CONTROL = re.compile(r"([<\[])(\\*)(?=\||/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=\||/?s>|/?INST\])")
_TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END), re.DOTALL)

EXAMPLES = "conv_id long, example long, text string, loss_start long, loss_end long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_BATCH_CHARS = 1 << 22


def escape(text: str) -> str:
    """Breaks every control string with a backslash; runs of backslashes there grow by one, so it can be undone."""
    return _CONTROL.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted text, as they were before formatting."""
    return ((unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted))


def expand(turns: Iterable[tuple]) -> Iterator[tuple]:
    """Examples of turns (conv_id, role, text) that come conversation by conversation, in order."""
    conv, context, example, open_turns = object(), [], 0, False

    def rest():
        if open_turns:
            whole = "".join(context)
            yield conv, example, whole, len(whole), len(whole)

    for conv_id, role, text in turns:
        if conv_id != conv:
            yield from rest()
            conv, context, example, open_turns = conv_id, [], 0, False
        body = escape(text or "")
        context.append(f"{START}{escape(role or '')}{TEXT}")
        if role == TRAINED:
            before = "".join(context)
            yield conv_id, example, f"{before}{body}{END}", len(before), len(before) + len(body)
            context = [before]
            example += 1
        open_turns = role != TRAINED
        context.append(f"{body}{END}")
    yield from rest()


def prefix_target_examples(conversations: DataFrame) -> DataFrame:
    """Every assistant turn of (conv_id, turn, role, text) as an example of its own.

    `text` is the formatted conversation up to and with that reply; only the
    code points from `loss_start` to `loss_end`, the reply itself, are trained
    on. Turns behind the last reply give one more example with nothing to train
    on (both ends equal), so that no turn is lost. Null texts and roles count as
    empty, only the role `assistant` is trained on, turns with the same number
    are ordered by role and text, repeated rows are repeated turns, rows with a
    null conv_id are one conversation.

    Rows are shuffled once and sorted within partitions; a task holds one
    conversation's text so far, never the rows of a group. The output grows with
    the square of a conversation's turns: that is the method.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(),
        F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first(),
    )

    def run(batches):
        turns = (
            (c, r.as_py(), t.as_py())
            for b in batches
            for c, r, t in zip(b.column("conv_id").to_pylist(), b.column("role"), b.column("text"))
        )
        yield from _batches(expand(turns), [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()], EXAMPLES, 2)

    return ordered.select("conv_id", "role", "text").mapInArrow(run, EXAMPLES)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what its examples hold: turns, trained text and formatted length.

    Works along the partitions of `prefix_target_examples`, where a
    conversation's examples follow one another. Of each example only the turns
    that its predecessor lacks are read again.
    """

    def run(batches):
        rows = (
            row
            for b in batches
            for row in zip(b.column(0).to_pylist(), b.column(2), b.column(3).to_pylist(), b.column(4).to_pylist())
        )
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield from _batches(_digests(rows), kinds, DIGESTS, 2)

    return examples.mapInArrow(run, DIGESTS)


def _digests(rows: Iterable[tuple]) -> Iterator[tuple]:
    conv, seen, n, chars, formatted = object(), 0, 0, 0, 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def done():
        if formatted:
            yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted

    for conv_id, text, start, end in rows:
        text = text.as_py()
        if conv_id != conv:
            yield from done()
            conv, seen, n, chars, formatted = conv_id, 0, 0, 0, 0
            turns, loss = hashlib.sha256(), hashlib.sha256()
        for role, said in read_turns(text[seen:]):
            turns.update(f"{role}\n{said}\n".encode())
            n += 1
        reply = unescape(text[start:end])
        loss.update(reply.encode())
        chars += len(reply)
        seen = len(text)
        formatted += len(text)
    yield from done()


def _batches(rows: Iterable[tuple], kinds: list, schema: str, weight: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in schema.split(", ")]

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)

    part, size = [], 0
    for row in rows:
        part.append(row)
        size += 100 + len(row[weight])
        if size > _BATCH_CHARS:
            yield batch(part)
            part, size = [], 0
    if part:
        yield batch(part)
