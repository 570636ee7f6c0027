"""Substring duplicates by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where its top bits are zero and no
such place lies just before. Both depend on the bytes nearby only, so chunks fall
in step again soon after an insertion. Chunks are compared by a 128-bit digest;
the first of equal chunks stays, and runs of the others are removed if they are
long enough not to be chance, or the whole of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ludometry.llm.base import batches, slices
from ludometry.llm.suffixes import (
    ANCHOR,
    _combined,
    _record,
    digests,
    kept_texts,
    meet,
    with_own_ids,
)

# Chance of a cut 1 in 2^BITS; bytes that a cut keeps from the cut before it;
# bytes a run of repeated chunks must have to be removed, if it is not a whole text.
BITS, APART, LEAST = 5, 8, 100
WINDOW = 32
BUFFER = 1 << 21
SLICE = 4 << 20
GEAR = np.random.default_rng(32).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Of each byte, the gear hash of it and the 31 before: sum of gear << age."""
    out = GEAR[data]
    age = 1
    while age < WINDOW:  # twice as many bytes at each step
        out[age:] = out[age:] + (out[:-age] << np.uint32(age)) if len(out) > age else out[age:]
        age *= 2
    return out


def cut_points(data: bytes, bits: int = BITS, apart: int = APART) -> np.ndarray:
    """Ends of the chunks of a text; the last is its length. Reads a buffer at a time."""
    found: list[np.ndarray] = []
    before = WINDOW + apart
    for start in range(0, len(data), BUFFER):
        low = max(0, start - before)
        part = np.frombuffer(data, dtype=np.uint8, count=min(len(data), start + BUFFER) - low, offset=low)
        zero = np.flatnonzero(gear_hashes(part) >> np.uint32(32 - bits) == 0)
        alone = zero[np.diff(zero, prepend=-apart - 1) > apart] + low + 1
        found.append(alone[alone > start])
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def chunks(docs: DataFrame, bits: int = BITS, apart: int = APART) -> DataFrame:
    """Rows of ANCHOR: two halves of each chunk's digest, doc_id, start and length.

    Copies within a batch come as ranges already known to be repeated.
    """
    schema = batches(ANCHOR)

    def made(part: pa.RecordBatch) -> list[np.ndarray] | None:
        digest = xxhash.xxh3_128_digest
        marks: list[bytes] = []
        starts, sizes, ids = [], [], []
        values = part["text"].cast(pa.binary())
        for row in np.argsort(part["doc_id"].to_numpy(), kind="stable").tolist():
            data = values[row].as_py()
            if not data:
                continue
            ends = cut_points(data, bits, apart)
            begins = np.concatenate(([0], ends[:-1]))
            marks.extend(digest(data[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True))
            starts.append(begins)
            sizes.append(ends - begins)
            ids.append(np.full(len(ends), part["doc_id"][row].as_py(), dtype=np.int64))
        if not marks:
            return None
        halves = np.frombuffer(b"".join(marks), dtype=np.uint64).reshape(-1, 2)
        start = np.concatenate(starts)
        return [halves[:, 0].copy(), halves[:, 1].copy(), np.concatenate(ids), start, np.concatenate(sizes), np.zeros(len(start), np.int64)]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            parts = [own for part in slices(batch, "text", SLICE) if (own := made(part))]
            if parts:
                columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
                order = np.lexsort((columns[3], columns[2]))
                yield _record(_combined([c[order] for c in columns], 1), schema)

    return docs.mapInArrow(run, ANCHOR)


def repeated(docs: DataFrame, bits: int = BITS, apart: int = APART) -> DataFrame:
    """(doc_id, start, stop) of every chunk that an earlier one equals.

    Earlier means a smaller doc_id, or the same one and a smaller start; doc_id
    is a unique non-null long.
    """
    return meet(chunks(docs, bits, apart), 1).filter("place < 0").select("doc_id", "start", "stop")


def dedup(docs: DataFrame, bits: int = BITS, apart: int = APART, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed are runs of at least ``least`` bytes of chunks that stand earlier in
    the table (smaller doc_id) or in the text, and texts of such chunks alone, so
    that of exact copies one stays however short they are. Null texts count as empty; short
    texts are one chunk; texts of any length are read whole, a buffer at a time.
    Rows that share a doc_id, or have none, each give a row and stand by text,
    null ids first. Other columns are ignored; an empty table gives an empty result.
    """
    return with_own_ids(docs, lambda rows: digests(rows, repeated(rows, bits, apart), least))


def deduplicated(docs: DataFrame, bits: int = BITS, apart: int = APART, least: int = LEAST) -> DataFrame:
    """(doc_id, text, n_removed): the texts that are left."""
    return with_own_ids(docs, lambda rows: kept_texts(rows, repeated(rows, bits, apart), least))
