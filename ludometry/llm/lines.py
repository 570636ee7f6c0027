"""Fuzzy line deduplication: MinHash candidates, exact Jaccard, union-find.

Lines are known by a digest; equal lines are one line. Signatures come from
hashed character shingles by one-permutation MinHash, empty bins filled from
others, and are cut into bands. Lines that share a band are candidates; those of
one band and one bucket are compared by the exact Jaccard similarity of their
shingles, unless they are joined already, so copies of a line cost one comparison
each and not one for each pair. Of every component the first line stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import batches, few, numbered, slices, written
from ludometry.llm.components import components
from ludometry.llm.rolling import mix, ranges
from ludometry.llm.suffixes import with_own_ids

# Characters of a shingle, bands, rows of a band, least similarity. A pair at 0.8
# shares no band with probability 0.002, one at 0.85 with 0.0001.
SHINGLE, BANDS, ROWS, LEAST = 8, 12, 4, 0.8
BINS = BANDS * ROWS
# The bits of a key that tell its band.
COLUMN = 15
# Members of a bucket compared in one task.
BLOCK = 2_000
SLICE = 1 << 20
# Characters that are hashed at a time.
CACHED = 1 << 16
OCCURRENCE = "line_id long, check long, doc_id long, line int, bands array<long>"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
# The hashes of the first code points, which most lines keep to.
_LOW = mix(np.arange(1, 0x2101, dtype=np.uint64))


def shingle_set(line: str) -> set[str]:
    """The distinct shingles of a line; a shorter line is one shingle."""
    return {line[k : k + SHINGLE] for k in range(max(1, len(line) - SHINGLE + 1))}


def jaccard(one: set[str], other: set[str]) -> float:
    shared = len(one & other)
    return shared / (len(one) + len(other) - shared)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all lines, in order and repeated ones too, and the line of each."""
    padded = [line.ljust(SHINGLE, "\0") for line in lines]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    hashes = _LOW[codes] if len(codes) and codes.max() < len(_LOW) else mix(codes.astype(np.uint64) + np.uint64(1))
    reach = 1
    while reach < SHINGLE:  # of twice as many characters at each step
        following = hashes[reach:]
        hashes = hashes[:-reach] * np.uint64(0x9E3779B97F4A7C15 + 2 * reach)
        hashes += following
        reach *= 2
    inside = np.ones(len(hashes), dtype=bool)  # the shingles that end in their line
    ends = np.cumsum(sizes)[:-1]
    for k in range(1, SHINGLE):
        inside[ends - k] = False
    return mix(hashes[inside]), np.repeat(np.arange(len(lines)), sizes - SHINGLE + 1)


def shingles_of(lines: list[str]) -> list[np.ndarray]:
    """The hashes of every line's shingles, repeated ones too."""
    out: list[np.ndarray] = []
    for block in _blocks(lines):
        hashes, owner = shingle_hashes(block)
        out.extend(np.split(hashes, np.cumsum(np.bincount(owner, minlength=len(block)))[:-1]))
    return out


def signatures(lines: list[str]) -> np.ndarray:
    """Lines x BINS: the smallest shingle hash of each bin, empty bins filled.

    An empty bin takes the value of a bin drawn by a hash of its number and the
    attempt, the same for all lines, until one is not empty.
    """
    hashes, owner = shingle_hashes(lines)
    bins = (hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)
    out = np.full(len(lines) * BINS, _EMPTY, dtype=np.uint64)
    np.minimum.at(out, owner * BINS + bins.astype(np.int64), mix(hashes))
    out = out.reshape(len(lines), BINS)
    filled = out != _EMPTY
    row, column = np.nonzero(~filled)
    attempt = np.uint64(1)
    while len(row):
        drawn = mix(column.astype(np.uint64) * np.uint64(1 << 20) + attempt) % np.uint64(BINS)
        hit = filled[row, drawn.astype(np.int64)]
        out[row[hit], column[hit]] = out[row[hit], drawn[hit].astype(np.int64)]
        row, column = row[~hit], column[~hit]
        attempt += np.uint64(1)
    return out


def _blocks(lines: list[str]) -> Iterator[list[str]]:
    """Lines in blocks whose arrays fit into the nearer caches."""
    start, held = 0, 0
    for k, line in enumerate(lines):
        if held > CACHED:
            yield lines[start:k]
            start, held = k, 0
        held += len(line)
    if lines:
        yield lines[start:]


def band_keys(lines: list[str]) -> np.ndarray:
    """Lines x BANDS: a hash of the band's number and rows, the number itself in the last bits."""
    made = [_band_keys(block) for block in _blocks(lines)]
    return np.concatenate(made) if made else np.zeros((0, BANDS), np.int64)


def _band_keys(lines: list[str]) -> np.ndarray:
    parts = signatures(lines).reshape(len(lines), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k])
    return (key & ~np.uint64(COLUMN) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _lines(text: str) -> list[tuple[int, str]]:
    """Number and stripped text of every line that is not blank."""
    return [(k, own) for k, line in enumerate(text.split("\n")) if (own := line.strip())]


def _digest(line: str) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return (value >> 64) - (1 << 63), (value & ((1 << 64) - 1)) - (1 << 63)


def occurrences(docs: DataFrame) -> DataFrame:
    """OCCURRENCE of every line; of equal lines of a slice only the first has bands."""
    schema = batches(OCCURRENCE)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                number: dict[str, int] = {}
                own, ids, at = [], [], []
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    for place, line in _lines(text or ""):
                        own.append(number.setdefault(line, len(number)))
                        ids.append(doc_id)
                        at.append(place)
                if not own:
                    continue
                distinct = list(number)
                digests = np.array([_digest(line) for line in distinct], dtype=np.int64)
                own = np.array(own)
                _, first = np.unique(own, return_index=True)
                has = np.zeros(len(own), dtype=bool)
                has[first] = True
                keys = band_keys(distinct)[own[has]].ravel()
                offsets = np.concatenate(([0], np.cumsum(np.where(has, BANDS, 0)))).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))
                columns = [digests[own, 0], digests[own, 1], ids, at, bands]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.mapInArrow(run, OCCURRENCE)


def _buckets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (band, line_id) to members of buckets of two different lines or more.

    Each member carries its place in the bucket; nothing but the last row is held.
    """
    schema = pa.schema([(name, pa.int64()) for name in ("band", "line_id", "place")])
    band, line, place, held = None, None, 0, False
    for batch in stream:
        bands, lines = batch["band"].to_numpy(), batch["line_id"].to_numpy()
        if not len(bands):
            continue
        fresh = np.ones(len(bands), dtype=bool)
        fresh[1:] = (bands[1:] != bands[:-1]) | (lines[1:] != lines[:-1])
        fresh[0] = (bands[0], lines[0]) != (band, line)
        bands, lines = bands[fresh], lines[fresh]
        if not len(bands):
            continue
        starts = np.ones(len(bands), dtype=bool)
        starts[1:] = bands[1:] != bands[:-1]
        starts[0] = bands[0] != band
        first = np.maximum.accumulate(np.where(starts, np.arange(len(bands)), -1))
        places = np.where(first >= 0, np.arange(len(bands)) - first, np.arange(len(bands)) + place + 1)
        # A first member is let go only when a second one follows.
        followed = np.append(~starts[1:], False)
        out = (places > 0) | followed
        if held and places[0] > 0:
            yield pa.RecordBatch.from_arrays([pa.array([band]), pa.array([line]), pa.array([0])], schema=schema)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(bands[out]), pa.array(lines[out]), pa.array(places[out])], schema=schema)
        band, line, place = int(bands[-1]), int(lines[-1]), int(places[-1])
        held = place == 0


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


def linked_pairs(
    ids: list[int], blocks: list[int], keys: list[np.ndarray], shingles: list[np.ndarray], column: int, least: float
) -> list[tuple[int, int]]:
    """Links that join what is similar among the members of one task.

    ``keys`` are the bands of every member and ``column`` is the bucket's own: a pair
    is compared only in the first of the buckets that it shares. Members of one
    block are compared with each other if there is one block, else only with those
    of the other. Pairs that are joined already are passed over.
    """
    if len(ids) == 2:  # most buckets
        shared = keys[0] == keys[1]
        if not shared[column] or shared[:column].any():
            return []
        both = len(_distinct(np.concatenate(shingles)))
        common = len(_distinct(shingles[0])) + len(_distinct(shingles[1])) - both
        return [(ids[1], ids[0])] if common >= least * both - 1e-9 else []
    raw = np.fromiter(map(len, shingles), np.int64, len(shingles))
    flat, inverse = np.unique(np.concatenate(shingles), return_inverse=True)
    # The distinct shingles of every member, one member after another.
    own = _distinct(np.repeat(np.arange(len(ids)), raw) * len(flat) + inverse)
    member, elements = own // len(flat), own % len(flat)
    sizes = np.bincount(member, minlength=len(ids))
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    ordered, bands, block = sizes[order], np.stack(keys)[order], np.array(blocks)[order]
    apart = block.min() != block.max()
    marks, label, links = np.zeros(len(flat), dtype=bool), np.arange(len(ids)), []
    for x in range(1, len(ids)):
        low = int(np.searchsorted(ordered, np.ceil(least * ordered[x] - 1e-9)))
        open_ = label[low:x] != label[x]
        if apart:
            open_ &= block[low:x] != block[x]
        others = low + np.flatnonzero(open_)
        if not len(others):
            continue
        shared = bands[others] == bands[x]
        others = others[(shared.argmax(axis=1) == column) & shared[:, column]]
        if not len(others):
            continue
        begin = starts[order[x]]
        mine = elements[begin : begin + ordered[x]]
        marks[mine] = True
        held = marks[elements[ranges(starts[order[others]], ordered[others])]].astype(np.int64)
        marks[mine] = False
        common = np.add.reduceat(held, np.cumsum(ordered[others]) - ordered[others])
        near = others[common >= least * (ordered[others] + ordered[x] - common) - 1e-9]
        for y in near[np.unique(label[near], return_index=True)[1]].tolist():
            links.append((ids[order[x]], ids[order[y]]))
            label[label == label[y]] = label[x]
    return links


def _verify(least: float):
    """Streams (band, task, column, block, line_id, text, bands) sorted by (band, task) into links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, column, held = None, 0, []

        def made() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            links = linked_pairs(*map(list, zip(*held, strict=True)), column, least)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], schema=schema)

        for batch in stream:
            for part in slices(batch, "text", SLICE):
                sets = shingles_of(part["text"].to_pylist())
                keys = part["bands"].flatten().to_numpy().reshape(-1, BANDS)
                rows = zip(*(part[c].to_pylist() for c in ("band", "task", "column", "block", "line_id")), strict=True)
                for k, (band, task, own, block, line_id) in enumerate(rows):
                    if (band, task) != key:
                        yield from made()
                        key, column, held = (band, task), own, []
                    held.append((line_id, block, keys[k].copy(), sets[k].copy()))  # no slice is held by its rows
        yield from made()

    return run


def _links(tasks: DataFrame, texts_: DataFrame, least: float) -> DataFrame:
    """Verified links of tasks (band, column, task, block, line_id)."""
    rows = tasks.join(texts_, "line_id").select("band", "task", "column", "block", "line_id", "text", "bands")
    dealt = rows.repartition("band", "task").sortWithinPartitions("band", "task")
    return written(dealt.mapInArrow(_verify(least), "a long, b long"), "links")


def _candidate_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line_id, text, bands) of the wanted lines, each once."""
    schema = batches("line_id long, text string")
    whole = "line_id long, text string, bands array<long>"
    banded = batches(whole)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                own = list({line: None for text in part["text"].to_pylist() for _, line in _lines(text or "")})
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array([_digest(line)[0] for line in own], pa.int64()), pa.array(own, pa.string())], schema=schema)

    def with_bands(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                keys = band_keys(part["text"].to_pylist())
                offsets = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
                bands = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part["line_id"], part["text"], bands], schema=banded)

    lines = docs.mapInArrow(run, "line_id long, text string")
    wanted = few(written(wanted, "wanted"))
    each = lines.join(wanted, "line_id", "left_semi").groupBy("line_id").agg(F.min("text").alias("text"))
    return written(each.mapInArrow(with_bands, whole), "texts")


def similar_lines(docs: DataFrame, found: DataFrame, least: float = LEAST) -> DataFrame:
    """(node, component) of the lines of ``found`` (occurrences) that are joined to others."""
    entries = found.filter("bands IS NOT NULL AND size(bands) > 0").select("line_id", F.explode("bands").alias("band"))
    dealt = entries.repartition("band").sortWithinPartitions("band", "line_id")
    members = written(dealt.mapInArrow(_buckets, "band long, line_id long, place long"), "buckets")
    # Buckets of the same members are one: near copies share most of their bands. The first
    # column stands for them, as a pair is compared in the first bucket that it shares.
    same = members.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("line_id")).alias("x"), F.bit_xor(F.xxhash64("line_id", F.lit(1))).alias("y")
    )
    kept = same.withColumn("column", F.col("band").bitwiseAND(F.lit(COLUMN)).cast("int"))
    kept = kept.groupBy("n", "x", "y").agg(F.min(F.struct("column", "band")).alias("kept")).select("kept.band", "kept.column", "n")
    tasks = written(
        members.join(kept, "band").select(
            "band", "column", "n", "line_id", "place", F.floor(F.col("place") / BLOCK).alias("block"), F.ceil(F.col("n") / BLOCK).alias("blocks")
        ),
        "tasks",
    )
    texts_ = _candidate_texts(docs, tasks.select("line_id").distinct())
    # A long bucket is cut into blocks; its first member is in all of them.
    own = tasks.select("band", "column", F.col("block").alias("task"), F.lit(0).alias("block"), "line_id")
    bridges = tasks.filter("place = 0 AND blocks > 1").select(
        "band", "column", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("task"), F.lit(0).alias("block"), "line_id"
    )
    links = _links(own.unionByName(bridges), texts_, least)
    joined = components(links)
    long = tasks.filter("blocks > 1")
    if long.isEmpty():
        return joined
    # Where a long bucket is not one component, all its blocks meet in pairs.
    labelled = long.join(joined, long["line_id"] == joined["node"], "left").withColumn("label", F.coalesce("component", "line_id"))
    apart = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("band")
    open_ = long.join(apart, "band").select("band", "column", "line_id", "block", "blocks")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = open_.withColumn("other", F.explode(others)).filter("other <> block").select(
        "band", "column", (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("task"), "block", "line_id"
    )
    return components(links.unionByName(_links(pairs, texts_, least)))


def repeated_lines(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, line, first_doc, first_line) of every line that an earlier one stands for.

    Earlier is by doc_id and line number. Two different lines whose digests agree
    in their first half are left alone, as nothing is known of either.
    """
    found = written(occurrences(docs), "lines")
    joined = similar_lines(docs, found, least)
    own = found.join(joined, found["line_id"] == joined["node"], "left").select(
        F.coalesce("component", "line_id").alias("class"), "line_id", "check", "doc_id", "line"
    )
    clash = own.groupBy("line_id").agg(F.min("check").alias("a"), F.max("check").alias("b")).filter("a <> b").select("line_id")
    clash = written(clash, "clashes")
    if not clash.isEmpty():
        own = own.join(clash, "line_id", "left_anti")
    classes = own.groupBy("class").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    twice = classes.filter("n > 1").select("class", F.col("first.doc_id").alias("first_doc"), F.col("first.line").alias("first_line"))
    twice = few(written(twice, "first"))
    return own.join(twice, "class").filter("doc_id <> first_doc OR line <> first_line").select("doc_id", "line", "first_doc", "first_line")


RESULT = (
    "doc_id long, text string, n_lines long, n_removed long, "
    "removed array<struct<line:int,first_doc:long,first_line:int>>"
)


def _cut(docs: DataFrame, repeated: DataFrame, schema: str, row_of) -> DataFrame:
    arrow = batches(schema)
    lists = repeated.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line", "first_doc", "first_line"))).alias("found"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                rows = []
                for doc_id, text, found in zip(*(part[c].to_pylist() for c in ("doc_id", "text", "found")), strict=True):
                    gone = {own["line"] for own in found or ()}
                    all_lines = (text or "").split("\n")
                    left = text if not gone else "\n".join(line for k, line in enumerate(all_lines) if k not in gone)
                    rows.append((doc_id, *row_of(left, len(all_lines), found or [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return docs.join(lists, "doc_id", "left").select("doc_id", "text", "found").mapInArrow(run, schema)


def deduplicated(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """RESULT: each document's text without the lines that earlier ones stand for.

    Lines are compared without the white space around them; blank lines always
    stay. ``removed`` names each line taken out, by number, and the line that
    stands for it. Null texts stay null, empty ones empty, and have one line.
    Rows that share a doc_id, or have none, each give a row; they stand by text,
    null ids first. Other columns are ignored; an empty table gives an empty result.
    """
    def run(rows: DataFrame) -> DataFrame:
        return _cut(rows, repeated_lines(rows, least), RESULT, lambda left, n, found: (left, n, len(found), found))

    return with_own_ids(docs, run)


def cleaned(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents, all columns, with the texts that are left, and n_chars of those.

    A document all of whose lines stand earlier stays with an empty text.
    """
    rows, key = numbered(docs, "doc_id", "text")
    own = rows.select(F.col(key).alias("doc_id"), F.col("text").cast("string").alias("text"))
    repeated = repeated_lines(own, least).groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    # The row is one column, so that no name of its own can clash.
    whole = rows.select(F.col(key).alias("doc_id"), F.struct(*docs.columns).alias("row"))
    joined = whole.join(repeated, "doc_id", "left")
    before = F.col("row.text")
    kept = F.filter(F.split(before, "\n", -1), lambda line, k: ~F.array_contains("gone", k))
    text = F.when(F.col("gone").isNull(), before).otherwise(F.array_join(kept, "\n"))
    fields = {"text": text, "n_chars": F.length(text).cast("long")}
    return joined.select(*(fields.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def digests(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The same with ``kept_sha256``, the SHA-256 of the text that is left, for the text.

    Null and empty texts have the digest of the empty text; repeated and null
    doc_ids, other columns and empty tables are as in ``deduplicated``.
    """
    schema = RESULT.replace("text string", "kept_sha256 string")

    def run(rows: DataFrame) -> DataFrame:
        def row(left, n, found):
            return hashlib.sha256((left or "").encode("utf-8", "surrogatepass")).hexdigest(), n, len(found), found

        return _cut(rows, repeated_lines(rows, least), schema, row)

    return with_own_ids(docs, run)
