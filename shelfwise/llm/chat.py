"""Chat formatting: turns between control strings, and one training example for each assistant turn.

A conversation is formatted once, turn by turn: ``<|turn|>role<|text|>text<|end|>``. The example of
an assistant turn is the formatted conversation up to the end of that turn, with its text alone
under the loss mask; as every example is a prefix, it is a place in the formatted text rather than a
copy of it. Control strings inside roles and texts get a backslash after their first character, and
one more for each that is there already, so the escape can be undone and no text can end its turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings of this and of other templates; fixed values, after their first character.
_CONTROL = r"\||s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]|pad>|unk>"
_PLAIN = re.compile(r"([<\[])(\\*)(?=" + _CONTROL + ")")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=" + _CONTROL + ")")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of its text in it)."""
    head = TURN + escape(role) + TEXT
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    if not (formatted.startswith(TURN) and formatted.endswith(END)):
        raise ValueError("not a turn")
    role, text = formatted[len(TURN) : -len(END)].split(TEXT, 1)
    return unescape(role), unescape(text)


def _in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, role, text by conversation and turn; equal turns by role, then text; a missing turn first."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, place, role, formatted, start, text_start, text_end for each turn.

    start, text_start and text_end are code points of the formatted conversation, whose text is that
    of its turns in order of place. Turns pass a task as a stream, so a conversation may be of any
    length. Null roles and texts are empty; rows without a conv_id form one conversation of their own.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("formatted", pa.string()), ("start", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, place, at = object(), 0, 0
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != open_:
                    open_, place, at = conv_id, 0, 0
                formatted, begin, end = format_turn(role, text)
                for column, value in zip(out, (conv_id, place, role, formatted, at, at + begin, at + end)):
                    column.append(value)
                place, at = place + 1, at + len(formatted)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return _in_order(conversations).mapInArrow(task, "conv_id long, place long, role string, formatted string, start long, text_start long, text_end long")


def prefix_targets(formatted: DataFrame, role: str = "assistant") -> DataFrame:
    """One example for each assistant turn: conv_id, example (its place), context_end, loss_start, loss_end.

    The example's text is the first ``loss_end`` code points of the formatted conversation and its end
    sign; everything before ``loss_start`` is context, only the text from there to ``loss_end`` is trained on.
    """
    return formatted.filter(F.col("role") == role).select(
        "conv_id", F.col("place").alias("example"), F.col("start").alias("context_end"), F.col("text_start").alias("loss_start"), F.col("text_end").alias("loss_end")
    )


def example_texts(formatted: DataFrame, role: str = "assistant") -> DataFrame:
    """The examples written out: conv_id, example, context, reply (still escaped).

    The contexts of one conversation are as large together as the square of its length, so this is
    for conversations that a model's context can hold; one context is held at a time.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("context", pa.string()), ("reply", pa.string())])

    def task(batches):
        open_, parts = object(), []
        for batch in batches:
            for conv_id, place, who, text, start, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != open_:
                    open_, parts = conv_id, []
                if who == role:
                    context = "".join(parts) + text[: begin - start]
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv_id, place, context, text[begin - start : end - start]), schema)], schema=schema)
                parts.append(text)

    rows = formatted.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(task, "conv_id long, example long, context string, reply string")


def read_back(formatted: DataFrame, role: str = "assistant") -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples, from the formatted turns alone.

    The examples of ``prefix_targets`` are dealt with the turns, each just before its turn, and what is
    under the mask of an example is read at its span. The digests are updated turn by turn.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done, open_example = None, [], None

        def close():
            if state:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5], state[6]))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for conv_id, place, text, start, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None:
                    if open_example:
                        raise ValueError("an example without a turn")
                    open_example = (conv_id, place, begin, end)
                    continue
                if not state or state[0] != conv_id:
                    close()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                who, said = parse_turn(text)
                state[1] += 1
                state[2].update(f"{who}\n{said}\n".encode("utf-8", "surrogatepass"))
                if open_example:
                    if open_example[:2] != (conv_id, place):
                        raise ValueError("an example without a turn")
                    begin, end = open_example[2:]
                    open_example = None
                    target = unescape(text[begin - start : end - start])
                    state[3] += len(target)
                    state[4].update(target.encode("utf-8", "surrogatepass"))
                    state[6] += 1
                state[5] += len(text)
            if len(done) >= 5000:
                yield batch_of(done)
                done = []
        if open_example:
            raise ValueError("an example without a turn")
        close()
        if done:
            yield batch_of(done)

    turns = formatted.select("conv_id", "place", F.lit(1).alias("kind"), "formatted", "start", F.lit(None).cast("long").alias("begin"), F.lit(None).cast("long").alias("end"))
    examples = prefix_targets(formatted, role).select(
        "conv_id", F.col("example").alias("place"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("formatted"), F.lit(None).cast("long").alias("start"), "loss_start", "loss_end"
    )
    rows = turns.union(examples).repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "place", "kind")
    return rows.drop("kind").mapInArrow(
        task, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"
    )
