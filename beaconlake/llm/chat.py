"""Conversations as training text, with a mask of what the model is to learn.

Control strings inside texts are made harmless and can be restored: every `<`, backslashes, `|` gets one backslash
more, so no text holds `<|`. In roles, backslashes and line breaks are escaped too.

Rows of a conversation follow turn (null first), then role and text, so ties have a fixed order; repeated rows are
turns of their own. Null role or text is empty. Rows with a null conversation id make one conversation. No rows give
no rows.

Scale: one shuffle by conversation; the rows of a conversation are read in order and written out in pieces of about
`PIECE_CHARS` characters, so a conversation of any length needs the memory of a piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.llm.template import compiled

PIECE_CHARS = 1 << 18
START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + message.role|escape_role + '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text|escape }}{% endgeneration %}"
    "{% else %}{{ message.text|escape }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}"
    "{% endfor %}"
)
FORMATTED = "conv_id long, piece int, text string, loss array<struct<start: long, end: long>>"
READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, whole boolean"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _conversations(rows: Iterator[dict]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Consecutive rows with the same id, as (id, iterator); each must be read to its end."""
    none = object()
    row = next(rows, none)

    def same(key) -> Iterator[dict]:
        nonlocal row
        while row is not none and row["conv_id"] == key:
            yield row
            row = next(rows, none)

    while row is not none:
        key = row["conv_id"]
        yield key, same(key)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row.get("text") or "")
        if len(held) >= size or chars >= 4 * PIECE_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_FORMATTED_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("piece", pa.int32()), ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
_READ_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("whole", pa.bool_()),
    ]
)


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, turn, role, text) -> pieces of formatted text with the spans under the loss mask.

    Spans are characters of their piece; a piece ends between two outputs of the template.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, {"escape": lambda x: escape(x or ""), "escape_role": lambda x: escape_role(x or "")})

        def pieces() -> Iterator[dict]:
            for key, messages in _conversations(_rows(batches)):
                texts: list[str] = []
                spans: list[dict] = []
                at = number = 0
                for text, marked in render({"messages": messages}):
                    if at and at + len(text) > PIECE_CHARS:
                        yield {"conv_id": key, "piece": number, "text": "".join(texts), "loss": spans}
                        texts, spans, at, number = [], [], 0, number + 1
                    if marked and text:
                        spans.append({"start": at, "end": at + len(text)})
                    texts.append(text)
                    at += len(text)
                for _ in messages:  # a template need not read them all
                    pass
                yield {"conv_id": key, "piece": number, "text": "".join(texts), "loss": spans}

        yield from _batches(pieces(), _FORMATTED_ARROW)

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(work, FORMATTED)


def _turns(texts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Turns of a formatted conversation; text that does not follow the format raises ValueError."""
    held = ""
    for text in texts:
        held += text
        at = 0
        while True:
            end = held.find(END + "\n", at)
            if end < 0:
                break
            line = held.find("\n", at)
            if not held.startswith(START, at) or line > end:
                raise ValueError("not a formatted conversation")
            yield unescape_role(held[at + len(START) : line]), unescape(held[line + 1 : end])
            at = end + len(END) + 1
        held = held[at:]
    if held:
        raise ValueError("not a formatted conversation")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from formatted pieces alone.

    `whole` is false for a conversation that does not follow the format; its turns are those up to the fault.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[dict]:
            for key, pieces in _conversations(_rows(batches)):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                count = loss_chars = chars = 0
                whole = True

                def texts() -> Iterator[str]:
                    nonlocal loss_chars, chars
                    for piece in pieces:
                        text = piece["text"]
                        chars += len(text)
                        for span in piece["loss"]:
                            plain = unescape(text[span["start"] : span["end"]])
                            loss_chars += len(plain)
                            loss.update(plain.encode())
                        yield text

                stream = texts()
                try:
                    for role, text in _turns(stream):
                        count += 1
                        turns.update(f"{role}\n{text}\n".encode())
                except ValueError:
                    whole = False
                    for _ in stream:
                        pass
                yield {
                    "conv_id": key, "n_turns": count, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": chars, "whole": whole,
                }

        yield from _batches(digests(), _READ_ARROW)

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return rows.mapInArrow(work, READ_BACK)
