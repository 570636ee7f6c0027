"""Conversations, one row per turn, formatted by a chat template."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import batches
from ludometry.llm.chat import TURNS, compile_template, read_turns, unescape

_ROWS = 200


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """Only the four columns; rows of a conversation follow each other by turn.

    Rows of one turn number stand by role and text, so ties have one order.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """(conv_id, its messages) one after another, a batch in memory at a time."""

    def rows():
        for batch in stream:
            names = ("conv_id", "turn", "role", "text")
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                yield from zip(*(part[name].to_pylist() for name in names), strict=True)

    for key, own in groupby(rows(), key=lambda row: row[0]):
        yield key, ({"turn": turn, "role": role or "", "content": text or ""} for _, turn, role, text in own)


def _streamed(turns: DataFrame, schema: str, template: str, row_of: Callable) -> DataFrame:
    arrow = batches(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        made: list[tuple] = []
        for key, messages in _conversations(stream):
            made.append((key, *row_of(render(messages))))
            for _ in messages:  # a template without a loop leaves messages unread
                pass
            if len(made) >= _ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)], schema=arrow)
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)], schema=arrow)

    return _sorted_turns(turns).mapInArrow(run, schema)


def format_conversations(turns: DataFrame, template: str = TURNS) -> DataFrame:
    """conv_id, formatted text, and the mask as spans [start, end) in code points.

    The text of a conversation is one cell, which Spark limits to 2 GB; use
    ``pieces`` for longer ones. Null roles and texts are empty; rows with a null
    conv_id are one conversation with a null id; repeated rows are turns of
    their own; other columns are ignored; no rows give no rows.
    """

    def row(pieces):
        parts, spans, at = [], [], 0
        for text, masked in pieces:
            if masked:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + len(text))
                else:
                    spans.append((at, at + len(text)))
            parts.append(text)
            at += len(text)
        return "".join(parts), [{"start": a, "end": b} for a, b in spans]

    schema = "conv_id long, formatted string, mask array<struct<start:long,end:long>>"
    return _streamed(turns, schema, template, row)


def read_back(turns: DataFrame, template: str = TURNS) -> DataFrame:
    """Digests of what a reader gets back from the formatted text.

    conv_id, n_turns, turns_sha256 over role, newline, text, newline of each
    turn, loss_chars and loss_sha256 over the unescaped text under the mask, and
    formatted_chars. A conversation is rendered and read as a stream, so one
    that holds a third of all rows needs no more memory than another.
    """

    def row(pieces):
        turns_digest, loss_digest = hashlib.sha256(), hashlib.sha256()
        counts = {"turns": 0, "loss": 0, "chars": 0}

        def texts():
            for text, masked in pieces:
                counts["chars"] += len(text)
                if masked:
                    learned = unescape(text)
                    counts["loss"] += len(learned)
                    loss_digest.update(learned.encode("utf-8", "surrogatepass"))
                yield text

        for role, text in read_turns(texts()):
            counts["turns"] += 1
            turns_digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        return (
            counts["turns"],
            turns_digest.hexdigest(),
            counts["loss"],
            loss_digest.hexdigest(),
            counts["chars"],
        )

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    return _streamed(turns, schema, template, row)
