"""Exact substring duplicates: every byte under a string that also starts earlier.

The corpus has a suffix per byte, too many to sort as a whole. So suffixes are
dealt out first: in each window of ``length`` bytes the gram with the smallest
hash is its anchor. Equal windows have equal anchors at equal places, so a window
can only repeat where its anchor's gram does, and grams that occur once are
dropped. Neighbouring windows with one anchor are one segment. Equal segments
repeat as a whole; of those the first stands for all. Segments that share a gram
but differ are sorted as suffixes: a merge sort whose comparisons find the common
extension of two suffixes by binary search on prefix polynomial hashes. Equal
windows come out side by side, are compared byte by byte, and all but the first
are duplicates.

No gram's rows need to fit in a task. Copies of a segment are combined in each
batch before the shuffle. Grams met very often are known from a sample of
documents, and those of many different segments by their count: their windows
are dealt out one by one, by two hashes of the whole window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import batches, numbered, slices, texts, written
from ludometry.llm.rolling import (
    BUFFER,
    common_lengths,
    mix,
    prefix_hashes,
    ranges,
    span_hashes,
    window_minima,
)

LENGTH, GRAM = 100, 32
ANCHOR = "h long, segment long, doc_id long, start long, windows int, place int"
MET = "h long, doc_id long, start long, stop long, place int"
SEGMENT = "h long, doc_id long, start long, place int, bytes binary"
WINDOW = ANCHOR
REMOVED = "doc_id long, start long, stop long"
# A gram of more different segments has its windows dealt out one by one; so has
# one of over a 100,000th of all anchors, which bounds the list of those.
MANY, HOT_SHARE, SAMPLE = 1_000, 100_000, 16
SLICE = 4 << 20
SORTED = 1 << 19


class Pieces:
    """Texts cut into buffers; a long text is cut with an overlap of a window."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.parts: list[bytes] = []
        self.ids: list[int] = []
        self.starts: list[int] = []
        self.size = 0

    def add(self, doc_id: int, data: bytes) -> Iterator[tuple]:
        for start in range(0, max(len(data) - self.length + 1, 0), BUFFER):
            part = data[start : start + BUFFER + self.length - 1]
            if self.size + len(part) > BUFFER and self.parts:
                yield self.buffer()
            self.parts.append(part)
            self.ids.append(doc_id)
            self.starts.append(start)
            self.size += len(part)

    def buffer(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, and of each part its doc_id, start in the text, and length."""
        out = (
            np.frombuffer(b"".join(self.parts), dtype=np.uint8),
            np.array(self.ids, dtype=np.int64),
            np.array(self.starts, dtype=np.int64),
            np.fromiter(map(len, self.parts), dtype=np.int64, count=len(self.parts)),
        )
        self.parts, self.ids, self.starts, self.size = [], [], [], 0
        return out


def _buffers(part: pa.RecordBatch, length: int) -> Iterator[tuple]:
    """Buffers of a batch of (doc_id, text), by doc_id."""
    pieces = Pieces(length)
    values = part["text"].cast(pa.binary())
    for row in np.argsort(part["doc_id"].to_numpy(), kind="stable").tolist():
        data = values[row].as_py()
        if data and len(data) >= length:
            yield from pieces.add(part["doc_id"][row].as_py(), data)
    if pieces.parts:
        yield pieces.buffer()


def buffer_anchors(buffer: tuple, length: int, gram: int, hot: np.ndarray) -> list[np.ndarray]:
    """Columns of ANCHOR for a buffer, in order of doc_id and start.

    Windows of ``hot`` grams (sorted) come one by one, by two hashes of their own.
    """
    data, ids, begun, sizes = buffer
    prefixes = prefix_hashes(data)
    grams, chosen = window_minima(prefixes, length, gram)
    offsets = np.cumsum(sizes) - sizes
    valid = ranges(offsets, sizes - length + 1)
    anchor = chosen[valid]
    fresh = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(valid, prepend=-2) != 1))
    windows = np.diff(fresh, append=len(valid))
    first, anchor = valid[fresh], anchor[fresh]
    h = grams[anchor]
    place = anchor - first
    other = prefix_hashes(data, 1)  # a code of its own: the gram's lies inside the segment
    segment = span_hashes(other, first, windows + length - 1)
    segment = mix(segment ^ (windows * 1_000_003 + place).astype(np.uint64))
    if len(hot):
        at = np.searchsorted(hot, h)
        is_hot = hot[np.minimum(at, len(hot) - 1)] == h
        if is_hot.any():
            times = np.where(is_hot, windows, 1)
            nth = ranges(np.zeros(len(times), np.int64), times)
            is_hot, h, segment, place, windows = (np.repeat(x, times) for x in (is_hot, h, segment, place, windows))
            first = np.repeat(first, times) + nth
            single = np.flatnonzero(is_hot)
            h[single] = mix(span_hashes(prefixes, first[single], length))
            segment[single] = mix(span_hashes(other, first[single], length))
            windows = np.where(is_hot, 1, windows)
            place = np.where(is_hot, 0, place)
    part = np.searchsorted(offsets, first, side="right") - 1
    return [h, segment, ids[part], first - offsets[part] + begun[part], windows, place]


def _combined(columns: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Copies within a batch taken out: each joins the removed range of its text.

    Ranges that are known are rows of no window: their end stands for the segment,
    and they are dealt out by document.
    """
    h, segment, doc_id, start, windows, place = columns
    order = np.argsort(h ^ segment * np.uint64(0x9E3779B97F4A7C15), kind="stable")
    same = (h[order[1:]] == h[order[:-1]]) & (segment[order[1:]] == segment[order[:-1]])
    copies = np.sort(order[1:][same])
    if not len(copies):
        return columns
    doc, lo = doc_id[copies], start[copies]
    hi = lo + windows[copies] + length - 1
    fresh = np.flatnonzero((np.diff(doc, prepend=doc[0] - 1) != 0) | (lo > np.concatenate(([0], hi[:-1]))))
    last = np.append(fresh[1:], len(copies)) - 1
    keep = np.ones(len(h), dtype=bool)
    keep[copies] = False
    zero = np.zeros(len(fresh), dtype=np.int64)
    known = [mix(doc[fresh].astype(np.uint64)), hi[last].astype(np.uint64), doc[fresh], lo[fresh], zero, zero]
    return [np.concatenate((own[keep], more)) for own, more in zip(columns, known, strict=True)]


def _record(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    made = [c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(made, schema, strict=True)], schema=schema)


def anchors(docs: DataFrame, length: int, gram: int, hot: np.ndarray) -> DataFrame:
    """Rows of ANCHOR for documents (doc_id, text)."""
    schema = batches(ANCHOR)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            made = [
                buffer_anchors(buffer, length, gram, hot)
                for part in slices(batch, "text", SLICE)
                for buffer in _buffers(part, length)
            ]
            if made:
                columns = [np.concatenate(x) for x in zip(*made, strict=True)]
                order = np.lexsort((columns[3], columns[2]))
                yield _record(_combined([c[order] for c in columns], length), schema)

    return docs.mapInArrow(run, ANCHOR)


def hot_grams(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """Grams estimated to hold over a ``HOT_SHARE``-th of all anchors, at most as many.

    Estimated from every ``SAMPLE``-th document. The estimate decides how windows
    are dealt out and not what is found.
    """
    schema = batches("h long")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                for buffer in _buffers(part, length):
                    yield _record(buffer_anchors(buffer, length, gram, np.zeros(0, np.uint64))[:1], schema)

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).mapInArrow(run, "h long")
    counts = written(sample.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "grams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(MANY / SAMPLE, total / HOT_SHARE)
    found = counts.filter(F.col("n") > least).select("h").toPandas()["h"].to_numpy(dtype=np.int64)
    return np.sort(found.view(np.uint64))


def _meeting(length: int):
    """Streams ANCHOR sorted by (h, segment, doc_id, start) into MET.

    Rows after the first of a segment are removed (place -1); the first rows of
    segments that share a gram with others are passed on to be sorted. One row is
    held back between batches.
    """
    schema = batches(MET)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (h, segment) of the last row
        held: list[np.ndarray] | None = None  # columns of the last first row
        joined = False  # whether its gram has had another segment
        for batch in stream:
            h, segment, doc_id, start, windows, place = (batch[k].to_numpy() for k in range(6))
            known = windows == 0
            if known.any():
                n = int(known.sum())
                yield _record([np.zeros(n, np.int64), doc_id[known], start[known], segment[known], np.full(n, -1)], schema)
                h, segment, doc_id, start, windows, place = (x[~known] for x in (h, segment, doc_id, start, windows, place))
            if not len(h):
                continue
            changed = np.ones(len(h), dtype=bool)
            changed[1:] = (h[1:] != h[:-1]) | (segment[1:] != segment[:-1])
            changed[0] = before != (h[0], segment[0])
            before = (h[-1], segment[-1])
            stop = start + windows + length - 1
            again = ~changed
            if again.any():
                n = int(again.sum())
                yield _record([np.zeros(n, np.int64), doc_id[again], start[again], stop[again], np.full(n, -1)], schema)
            firsts = [x[changed] for x in (h, doc_id, start, stop, place)]
            if held is not None:
                firsts = [np.concatenate(pair) for pair in zip(held, firsts, strict=True)]
            if not len(firsts[0]):
                continue
            alike = firsts[0][1:] == firsts[0][:-1]
            shared = np.zeros(len(firsts[0]), dtype=bool)
            shared[1:] |= alike
            shared[:-1] |= alike
            shared[0] |= joined and held is not None
            held, joined = [x[-1:] for x in firsts], bool(shared[-1])
            if shared[:-1].any():
                yield _record([x[:-1][shared[:-1]] for x in firsts], schema)
        if held is not None and joined:
            yield _record(held, schema)

    return run


def meet(rows: DataFrame, length: int) -> DataFrame:
    """MET of rows of ANCHOR."""
    dealt = rows.repartition("h").sortWithinPartitions("h", "segment", "doc_id", "start")
    return dealt.mapInArrow(_meeting(length), MET)


def _found(part: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of the column ``found`` (structs by row), the row of each struct and its fields."""
    lists = part["found"]
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    fields = lists.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), {
        f.name: fields.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(fields.type)
    }


def _extracted(docs_found: DataFrame) -> DataFrame:
    """SEGMENT of documents with ``found`` (h, start, stop, place)."""
    schema = batches(SEGMENT)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch.filter(pc.is_valid(batch["found"])), "text", SLICE):
                row, own = _found(part)
                values = part["text"].cast(pa.binary()).to_pylist()
                order = zip(row.tolist(), own["start"].tolist(), own["stop"].tolist(), strict=True)
                pieces = [values[r][a:b] for r, a, b in order]
                ids = part["doc_id"].to_numpy()[row]
                yield _record([own["h"], ids, own["start"], own["place"], pa.array(pieces, pa.binary())], schema)

    return docs_found.mapInArrow(run, SEGMENT)


def _single_windows(segments: DataFrame, length: int) -> DataFrame:
    """ANCHOR rows of all windows of SEGMENT rows, by two hashes of each window."""
    schema = batches(ANCHOR)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "bytes", BUFFER):
                data = np.frombuffer(b"".join(part["bytes"].to_pylist()), dtype=np.uint8)
                sizes = pc.binary_length(part["bytes"]).to_numpy().astype(np.int64)
                offsets = np.cumsum(sizes) - sizes
                at = ranges(offsets, sizes - length + 1)
                row = np.repeat(np.arange(len(sizes)), sizes - length + 1)
                h = mix(span_hashes(prefix_hashes(data), at, length))
                other = mix(span_hashes(prefix_hashes(data, 1), at, length))
                start = part["start"].to_numpy()[row] + at - offsets[row]
                one, zero = np.ones(len(at), np.int64), np.zeros(len(at), np.int64)
                columns = [h, other, part["doc_id"].to_numpy()[row], start, one, zero]
                order = np.lexsort((start, columns[2]))
                yield _record(_combined([c[order] for c in columns], length), schema)

    return segments.mapInArrow(run, ANCHOR)


def suffix_sort(data: np.ndarray, prefixes: np.ndarray, cells: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The order of suffixes by cell and first ``length`` bytes; stable.

    ``cells`` is sorted. A bottom-up merge sort of all cells at once: each suffix
    looks for its place in the neighbouring run by binary search, and two suffixes
    are compared by the byte after their common extension.
    """
    begun = np.flatnonzero(np.diff(cells, prepend=-1))
    sizes = np.diff(begun, append=len(cells))
    cell = np.repeat(np.arange(len(begun)), sizes)
    nth = np.arange(len(cells)) - begun[cell]
    order = np.arange(len(cells))
    run = 1
    while run < sizes.max(initial=0):
        # The other run of each position's pair of runs, as positions.
        pair = nth // (2 * run) * (2 * run)
        left = nth < pair + run
        low = np.minimum(np.where(left, pair + run, pair), sizes[cell])
        high = np.minimum(np.where(left, pair + 2 * run, pair + run), sizes[cell])
        base = begun[cell]
        other_begins = low.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            mine = at[order[open_]]
            theirs = at[order[base[open_] + middle]]
            shared = common_lengths(prefixes, theirs, mine, length)
            equal = shared == length
            step = np.minimum(shared, length - 1)
            before = data[theirs + step] < data[mine + step]
            # Equal suffixes keep their order: those of the left run come first.
            ahead = np.where(equal, ~left[open_], before)
            low[open_] = np.where(ahead, middle + 1, low[open_])
            high[open_] = np.where(ahead, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        mine_begins = np.where(left, pair, pair + run)
        place = base + pair + (nth - mine_begins) + (low - other_begins)
        sorted_ = np.empty_like(order)
        sorted_[place] = order
        order = sorted_
        run *= 2
    return order


def repeated_windows(h: np.ndarray, place: np.ndarray, pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of segments repeat one of an earlier segment of the same gram.

    Rows are sorted by gram, document and start. Returns the row of each such
    window and its place in the segment.
    """
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    prefixes = prefix_hashes(data)
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    offsets = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    row = np.repeat(np.arange(len(pieces)), windows)
    at = ranges(offsets, windows)
    # Equal windows lie at equal places around the gram: only those are compared.
    gram = np.cumsum(np.diff(h, prepend=h[:1]) != 0)[row]
    cells = gram * (2 * length) + (place[row] - (at - offsets[row]))
    order = np.argsort(cells, kind="stable")
    count = np.bincount(cells)
    order = order[count[cells[order]] > 1]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cells, row, at = cells[order], row[order], at[order]
    order = suffix_sort(data, prefixes, cells, at, length)
    a, b = order[:-1], order[1:]
    near = cells[a] == cells[b]
    a, b = a[near], b[near]
    same = common_lengths(prefixes, at[a], at[b], length) == length
    a, b = a[same], b[same]
    steps = np.arange(length)
    for part in range(0, len(a), 1 << 14):  # hashes may collide; bytes decide
        own = slice(part, part + (1 << 14))
        equal = (data[at[a[own]][:, None] + steps] == data[at[b[own]][:, None] + steps]).all(axis=1)
        b[own] = np.where(equal, b[own], -1)
    later = np.sort(b[b >= 0])
    return row[later], (at - offsets[row])[later]


def _sorting(length: int):
    """Streams SEGMENT sorted by (h, doc_id, start) into REMOVED."""
    schema = batches(REMOVED)

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        h, doc_id, start, place = (np.array(x, dtype=np.int64) for x in list(zip(*rows, strict=True))[:4])
        row, nth = repeated_windows(h, place, [r[4] for r in rows], length)
        order = np.lexsort((nth, row))
        row, nth = row[order], nth[order]
        fresh = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(nth, prepend=-2) != 1))
        last = np.append(fresh[1:], len(row)) - 1 if len(row) else fresh
        own = row[fresh]
        return _record([doc_id[own], start[own] + nth[fresh], start[own] + nth[last] + length], schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, cut = 0, 0  # bytes held; rows before the gram that is still coming
        for batch in stream:
            for at in range(0, batch.num_rows, 2000):
                for new in zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns), strict=True):
                    if rows and rows[-1][0] != new[0]:
                        cut = len(rows)
                        if size > SORTED:
                            yield solved(rows)
                            rows, size, cut = [], 0, 0
                    rows.append(new)
                    size += len(new[4])
        if rows:
            yield solved(rows)

    return run


def cut(
    values: list[bytes], row: np.ndarray, starts: np.ndarray, stops: np.ndarray, least: int = 1
) -> list[tuple[int, int, bytes]]:
    """Of each text the bytes removed, the number of spans, and what is left.

    Ranges that touch are one span; spans of under ``least`` bytes stay, unless
    they are the whole text.
    """
    order = np.lexsort((stops, starts, row))
    row, starts, stops = row[order], starts[order], stops[order]
    bounds = np.searchsorted(row, np.arange(len(values) + 1))
    out = []
    for k, data in enumerate(values):
        a, b = bounds[k], bounds[k + 1]
        if a == b:
            out.append((0, 0, data))
            continue
        reach = np.maximum.accumulate(stops[a:b])
        fresh = np.flatnonzero(np.concatenate(([True], starts[a + 1 : b] > reach[:-1])))
        begins, ends = starts[a:b][fresh], reach[np.append(fresh[1:], b - a) - 1]
        size = ends - begins
        long = (size >= least) | (size == len(data))
        begins, ends = begins[long].tolist(), ends[long].tolist()
        kept = [data[x:y] for x, y in zip([0, *ends], [*begins, len(data)], strict=True)]
        left = b"".join(kept)
        out.append((len(data) - len(left), len(begins), left))
    return out


def removed_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, start, stop): byte ranges under strings of ``length`` that start earlier.

    ``docs`` has unique non-null longs as doc_id. Ranges may overlap.
    """
    return _ranges(docs, length, gram)


def _by_document(docs: DataFrame, rows: DataFrame, *fields: str) -> DataFrame:
    """Documents with their rows as a list. The text is shuffled by doc_id."""
    lists = rows.groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("found"))
    return docs.join(lists, "doc_id", "left")


def _ranges(docs: DataFrame, length: int, gram: int) -> DataFrame:
    met = written(meet(anchors(docs, length, gram, hot_grams(docs, length, gram)), length), "met")
    again = met.filter("place < 0").select("doc_id", "start", "stop")
    shared = met.filter("place >= 0")
    many = shared.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MANY).select("h")
    few = written(shared.join(many, "h", "left_anti"), "few")
    segments = _extracted(_by_document(docs, few, "h", "start", "stop", "place"))
    by_gram = segments.repartition("h").sortWithinPartitions("h", "doc_id", "start")
    parts = [again, by_gram.mapInArrow(_sorting(length), REMOVED)]
    if not many.isEmpty():
        crowded = shared.join(many, "h", "left_semi")
        single = _single_windows(_extracted(_by_document(docs, crowded, "h", "start", "stop", "place")), length)
        parts.append(meet(single, length).filter("place < 0").select("doc_id", "start", "stop"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _cut_documents(docs: DataFrame, removed: DataFrame, least: int, schema: str, row_of) -> DataFrame:
    arrow = batches(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                row, own = _found(part)
                values = [value or b"" for value in part["text"].cast(pa.binary()).to_pylist()]
                made = [row_of(data, *found) for data, found in zip(values, cut(values, row, own["start"], own["stop"], least), strict=True)]
                columns = list(zip(*made, strict=True)) or [[] for _ in list(arrow)[1:]]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True))], schema=arrow)

    return _by_document(docs, removed, "start", "stop").mapInArrow(run, schema)


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def digests(docs: DataFrame, removed: DataFrame, least: int = 1) -> DataFrame:
    """DIGEST of documents less removed byte ranges, touching ones joined, of ``least`` bytes or a whole text."""

    def row(data: bytes, gone: int, spans: int, left: bytes) -> tuple:
        return len(data), gone, spans, hashlib.sha256(left).hexdigest()

    return _cut_documents(docs, removed, least, DIGEST, row)


def kept_texts(docs: DataFrame, removed: DataFrame, least: int = 1) -> DataFrame:
    """(doc_id, text, n_removed) of documents less the same ranges.

    A range may begin or end inside a character; what is left of it becomes U+FFFD.
    Null texts become empty; ``docs`` has unique, non-null doc_ids, and no document no row.
    """

    def row(data: bytes, gone: int, spans: int, left: bytes) -> tuple:
        return left.decode("utf-8", "replace"), gone

    return _cut_documents(docs, removed, least, "doc_id long, text string, n_removed long", row)


def with_own_ids(docs: DataFrame, operate) -> DataFrame:
    """``operate`` on (doc_id, text) whose ids are unique longs in order of doc_id.

    Rows without a doc_id come first; rows that share one stand by text. The
    result has the documents' own doc_id again.
    """
    rows, key = numbered(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", "text")
    made = operate(rows.select(F.col(key).alias("doc_id"), "text"))
    if key == "doc_id":
        return made
    names = rows.select(F.col(key).alias("_own"), F.col("doc_id").alias("_doc_id"))
    joined = made.join(names, made["doc_id"] == names["_own"])
    return joined.select(F.col("_doc_id").alias("doc_id"), *(c for c in made.columns if c != "doc_id"))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a string of ``length`` bytes that covers it also starts
    earlier: in a document of smaller doc_id, or earlier in the same one, where
    the two may overlap. Null texts count as empty; texts of under ``length``
    bytes lose nothing; texts of any length are read whole. Rows that share a
    doc_id, or have none, each give a row; they stand by text, null ids first.
    Other columns are ignored; an empty table gives an empty result.
    """
    return with_own_ids(docs, lambda rows: digests(rows, _ranges(rows, length, gram)))
