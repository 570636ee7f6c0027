"""SimHash near-duplicates by a byte-position index with count filtering.

A fingerprint is eight positional bytes. Fingerprints that differ in at most d
bits differ in at most d bytes, so they share at least 8 - d positional bytes.
The inverted index is keyed by combinations of positions rather than by single
ones: lists of one byte hold a 256th of all fingerprints and grow too long. The
combinations are chosen so that any 8 - d positions contain one of them, hence
every pair that can qualify meets in a list. Inside a list the shared positional
bytes of each pair are tallied, pairs below the guaranteed minimum are dropped,
and the rest is verified by the bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import batches, few, numbered, texts, written
from ludometry.llm.components import Forest, components

BYTES = 8
SEED = 42
# Members of a list compared at a time; the length from which a task splits a
# list by one more byte; the length from which a list is dealt out to more tasks.
BLOCK = 512
LONG_LIST = 256
MOST = 500_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a text; 0 where it has no word.

    A-Z is lower-cased, words are runs of anything but ASCII white space,
    shingles are ``shingle`` words joined by one space, repeats included; a text
    of fewer words is one shingle. A bit is set if it is set in over half of the
    XXH64 values of the shingles.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)),
        dtype=np.uint64,
        count=len(words) - shingle + 1,
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a text of any length, in bounded memory
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(np.uint64)[0])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with fp as a signed long, for rows of (doc_id, text)."""
    schema = batches("doc_id long, fp long")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            values = [fingerprint(text.as_py(), shingle) for text in batch["text"]]
            fps = _signed(np.array(values, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps)], schema=schema)

    return docs.mapInArrow(run, "doc_id long, fp long")


def first_positions(distance: int) -> list[tuple[int, ...]]:
    """Combinations of positions of which any 8 - ``distance`` positions contain one.

    By pigeonhole: more than half of them, rounded up, lie in one half of the eight.
    """
    shared = BYTES - distance
    if shared < 1:
        raise ValueError("a byte-position index needs a distance below 8")
    size = -(-shared // 2)
    halves = (range(BYTES // 2), range(BYTES // 2, BYTES))
    return [chosen for half in halves for chosen in combinations(half, size)]


def _bytes_mask(position: int) -> int:
    mask = 0xFF << (8 * position)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _entry(positions: tuple[int, ...]):
    """The index entry of a fingerprint at some positions: their bit set and bytes."""
    mask = sum(0xFF << (8 * position) for position in positions)
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    return F.struct(
        F.lit(sum(1 << position for position in positions)).alias("positions"),
        F.col("fp").bitwiseAND(F.lit(mask)).alias("value"),
    )


def spanning_pairs(values: np.ndarray, distance: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked among the distinct fingerprints of one list.

    Every pair is looked at, block by block, unless both are joined already; at
    most one link per joined member is returned, never all pairs.
    """
    values = np.unique(values)
    forest = Forest()
    label = np.arange(len(values))
    ones: list[int] = []
    others: list[int] = []
    table = values.view(np.uint8).reshape(-1, BYTES)
    for i in range(0, len(values), block):
        for j in range(i, len(values), block):
            left, right = slice(i, i + block), slice(j, j + block)
            both = np.concatenate((label[left], label[right]))
            if (both == both[0]).all():
                continue
            tally = np.zeros((len(values[left]), len(values[right])), dtype=np.uint8)
            for position in range(BYTES):
                tally += table[left, position][:, None] == table[right, position][None, :]
            a, b = np.nonzero(tally >= BYTES - distance)
            a, b = a + i, b + j
            keep = (a < b) & (label[a] != label[b])
            a, b = a[keep], b[keep]
            near = np.bitwise_count(values[a] ^ values[b]) <= distance
            before = len(ones)
            for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
                if forest.union(x, y):
                    ones.append(x)
                    others.append(y)
            if len(ones) > before:
                label = np.array([forest.find(x) for x in range(len(values))])
    return values[ones], values[others]


def list_links(positions: int, values: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside a list whose members share the bytes at ``positions`` (a bit set).

    Members that qualify share 8 - distance bytes at least, so a long list that
    shares fewer is split by each further byte before pairs are looked at.
    """
    if len(values) < 2:
        return
    if len(values) <= LONG_LIST or positions.bit_count() >= BYTES - distance:
        yield spanning_pairs(values, distance)
        return
    table = values.view(np.uint8).reshape(-1, BYTES)
    for position in range(BYTES):
        if positions >> position & 1:
            continue
        order = np.argsort(table[:, position], kind="stable")
        edges = np.flatnonzero(np.diff(table[order, position])) + 1
        for own in np.split(values[order], edges):
            yield from list_links(positions | 1 << position, own, distance)


def _links_of_lists(distance: int):
    """Streams rows sorted by (positions, value): links inside every list."""
    schema = batches("a long, b long")

    def made(key: tuple[int, int], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a, b in list_links(key[0], np.concatenate(held), distance):
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(a)), pa.array(_signed(b))], schema=schema
                )

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in stream:
            positions = batch["positions"].to_numpy()
            value = batch["value"].to_numpy()
            fps = batch["fp"].to_numpy().view(np.uint64)
            edges = np.flatnonzero((np.diff(positions) != 0) | (np.diff(value) != 0)) + 1
            bounds = [0, *edges.tolist(), len(value)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                own = (int(positions[a]), int(value[a]))
                if own != key:
                    if held:
                        yield from made(key, held)
                    key, held = own, []
                held.append(fps[a:b].copy())
        if held:
            yield from made(key, held)

    return run


def fingerprint_links(distinct: DataFrame, distance: int = 3, most: int = MOST) -> DataFrame:
    """(a, b): links that join all fingerprints linked at ``distance`` or fewer bits.

    ``distinct`` has one row per fingerprint ``fp`` (signed). The chains of links
    give the same components as all pairs would. Lists of over ``most`` members
    are dealt out again by each further byte until 8 - distance bytes are fixed,
    so what one task holds is bounded: by 256^distance fingerprints at worst.
    """
    index = distinct.select("fp", F.inline(F.array(*map(_entry, first_positions(distance)))))
    fixed = len(first_positions(distance)[0])
    while fixed < BYTES - distance:
        sizes = index.groupBy("positions", "value").agg(F.count(F.lit(1)).alias("n"))
        long = sizes.filter(F.col("n") > most).select("positions", "value")
        if long.isEmpty():
            break
        further = F.array(
            *(
                F.when(
                    F.shiftright("positions", position).bitwiseAND(F.lit(1)) == 0,
                    F.struct(
                        F.col("positions").bitwiseOR(F.lit(1 << position)).alias("positions"),
                        F.col("value").bitwiseOR(F.col("fp").bitwiseAND(F.lit(_bytes_mask(position)))).alias("value"),
                    ),
                )
                for position in range(BYTES)
            )
        )
        dealt = index.join(long, ["positions", "value"]).select("fp", F.inline(F.array_compact(further)))
        index = index.join(long, ["positions", "value"], "left_anti").select("fp", "positions", "value")
        index = written(index.unionByName(dealt), "lists")
        fixed += 1
    return (
        index.repartition("positions", "value")
        .sortWithinPartitions("positions", "value")
        .mapInArrow(_links_of_lists(distance), "a long, b long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that chains of fingerprints at
    ``distance`` or fewer differing bits reach, the document's own included.
    Null and empty texts, and texts of white space, have fingerprint zero and
    are linked like any other. Texts of any length are read whole. Equal
    fingerprints form one entry of the index however many documents share them.
    Rows with a null or repeated doc_id each give a row; a null id is no
    candidate for component_id unless the component has no other. Other columns
    are ignored; an empty table gives an empty result.
    """
    fps = written(fingerprints(texts(docs), shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(fingerprint_links(distinct.select("fp"), distance))
    named = distinct.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group")
    )
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    entry = named.join(smallest, "group").select(F.col("fp").alias("own"), "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return fps.join(entry, F.col("fp") == F.col("own")).select(
        "doc_id", digits.alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The documents with one of each group kept: the one with the smallest doc_id.

    All columns and texts stay as they are. Rows that share a doc_id are told
    apart, and the first of them by text is kept.
    """
    rows, key = numbered(docs, "doc_id", "text")
    groups = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), shingle, distance)
    gone = written(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "gone")
    return rows.join(few(gone), rows[key] == gone["_gone"], "left_anti").select(*docs.columns)
