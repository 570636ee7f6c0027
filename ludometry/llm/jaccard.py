"""Documents whose sets of word shingles are similar, joined exactly.

Sets that are J similar differ in few elements, at most H for their size. The
range of hashes is cut into more than H parts, so two such sets agree in a whole
part at least. A list holds the sets that agree in one part; sets meet in lists only.

What meets is compared in tasks of bounded size, each by the relations of its
sets. Lists of the task's elements are cut into blocks by the sizes of their sets
and carry positions; blocks whose positions leave too little room for an overlap
are skipped. A set that is scanned so lends its answers: those of a set that
differs in a few elements follow from them by the lists of just these elements.

Every set is first compared with all that have the same hub, the smallest set that
shares a list. Lists that still hold more than one component are then compared
pair by pair, so nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import few, row_keys, slices, written
from ludometry.llm.components import Forest, components

SLICE, PIECE = 4 << 20, 1 << 20
# Sets below SMALL elements meet by their sums; above it classes of sizes grow by GROWTH.
GROWTH = 1.25
# Elements of the sets of a task, and members of a list whose pairs one task lists.
TASK, BLOCK = 500_000, 1_000
# Sets whose digests a task remembers, so that copies give their keys once.
HELD = 200_000
SETS = "row long, doc_id long, n long, s1 long, s2 long, keys array<long>"
_SETS = pa.schema([(name, pa.int64()) for name in ("row", "doc_id", "n", "s1", "s2")] + [("keys", pa.list_(pa.int64()))])
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a buffer of bytes, A-Z lower-cased. Reads a piece at a time."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not _SPACE[data[end - 1]]:  # a piece ends with a space or with the buffer
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            end = at + int(spaces[-1]) + 1 if len(spaces) else min(len(data), end + PIECE)
        part = data[at:end]
        inside = ~_SPACE[part]
        first = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        if len(first):
            own = np.flatnonzero(inside)
            place = own - first[np.cumsum(np.isin(own, first, assume_unique=True)) - 1]
            letters = part[own].astype(np.uint64)
            letters += np.uint64(32) * ((letters >= 65) & (letters <= 90)).astype(np.uint64)
            spread = _mix(letters + (place.astype(np.uint64) << np.uint64(8)) + _A)
            hashes.append(_mix(np.add.reduceat(spread, np.searchsorted(own, first))))
            starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: pa.Array, shingle: int = 3) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of the shingles of each text; nulls have none."""
    raw = [(text.as_py() or "").encode() for text in texts]
    # A space after each text keeps the words of neighbours apart.
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    words, starts = word_hashes(data)
    at = np.searchsorted(starts, bounds)
    for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = words[low:high]
        size = min(shingle, len(own))
        if not size:
            yield own
            continue
        out = np.full(len(own) - size + 1, np.uint64(size))
        for k in range(size):
            out = out * _B + own[k : len(own) - size + 1 + k]
            out ^= out >> np.uint64(29)
        yield np.unique(_mix(out))


def differences(total: int, percent: int) -> int:
    """The most elements that are in one of two similar sets only, by the sum of their sizes."""
    return total * (100 - percent) // (100 + percent)


def largest(size: int, percent: int) -> int:
    """The size of the largest set that a set can be similar to."""
    return size * 100 // percent


class Classes:
    """Classes of sizes: in each, a smaller set meets larger ones in as many parts.

    Two similar sets lie in one class or in two that follow each other; the larger
    then joins the lists of the smaller one's class too.
    """

    def __init__(self, percent: int) -> None:
        if not 50 < percent <= 100:
            raise ValueError("the join is for similarities above one half")
        self.percent = percent
        self.growth = max(GROWTH, 100 / percent * 1.1)
        # Up to here two similar sets differ in one element at most.
        self.small = 1
        while differences(self.small + largest(self.small, percent), percent) <= 1:
            self.small += 1

    def edges(self, number: int) -> tuple[int, int]:
        low = self.small
        for _ in range(number):
            low = int(low * self.growth) + 1
        return low, int(low * self.growth) + 1

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(class, parts, differences) of every class a set of ``size`` takes part in, above the small ones."""
        number, found = 0, []
        while True:
            low, high = self.edges(number)
            if low > size:
                return found
            if size < high or (-(-size * self.percent // 100) < high):
                most = differences(high - 1 + largest(high - 1, self.percent), self.percent)
                found.append((number, most + 2 + (most + 1) // 4, most))
            number += 1


def _least(size: int) -> int:
    """Elements a part needs to be a key, if enough parts have them."""
    return 2 if size < 64 else 3


class Keys:
    """The lists that a set joins."""

    def __init__(self, percent: int) -> None:
        self.classes = Classes(percent)
        self.known: dict[int, list[tuple[int, int, int]]] = {}

    def __call__(self, own: np.ndarray) -> np.ndarray:
        size, small = len(own), self.classes.small
        percent, spread = self.classes.percent, _mix(own + _C)
        out = []
        if size and size <= largest(small - 1, percent) and differences(2 * size + 1, percent):
            # The set as a whole, and without each of its elements.
            total = spread.sum(dtype=np.uint64)
            out.append(_mix(np.append(total - spread, total) * _A))
        if size not in self.known:
            self.known[size] = self.classes.of(size)
        for number, parts, most in self.known[size]:
            part = (own >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            sums = np.add.reduceat(spread, starts)
            counts = np.diff(np.append(starts, size))
            names, good = part[starts], counts >= _least(size)
            if good.sum() > most:
                names, sums = names[good], sums[good]
            else:  # too few parts are rich; then all are keys, empty ones too
                every = np.zeros(parts, dtype=np.uint64)
                every[names.astype(np.int64)] = sums
                names, sums = np.arange(parts, dtype=np.uint64), every
            tag = _mix(names + np.uint64((number + 1) << 32))
            out.append(_mix(sums * _B + tag))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def digest(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as signed longs."""
    two = np.array([_mix(own + _A).sum(dtype=np.uint64), _mix(own + _B).sum(dtype=np.uint64)], dtype=np.uint64)
    return tuple(two.view(np.int64).tolist())


def _sets(percent: int, shingle: int):
    """Rows (row, doc_id, text) to SETS; of equal sets that a task remembers one has keys."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, seen = Keys(percent), set()
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                sizes, firsts, seconds, lists = [], [], [], []
                for own in shingle_sets(part["text"], shingle):
                    name = digest(own)
                    sizes.append(len(own))
                    firsts.append(name[0])
                    seconds.append(name[1])
                    if name in seen:
                        lists.append(np.zeros(0, np.uint64))
                        continue
                    if len(seen) >= HELD:
                        seen = set()
                    seen.add(name)
                    lists.append(keys(own))
                offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                values = pa.array(np.concatenate(lists).view(np.int64))
                columns = [part["row"], part["doc_id"], pa.array(sizes, pa.int64()), pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), values)], schema=_SETS)

    return run


def _lists(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, s1) sorted by both to (key, s1, first) of lists of two sets or more.

    ``first`` is the smallest s1 of the list. Nothing but the last row is held.
    """
    schema = pa.schema([(name, pa.int64()) for name in ("key", "s1", "first")])
    key, last, first, alone = None, None, None, False
    for batch in stream:
        keys, own = batch["key"].to_numpy(), batch["s1"].to_numpy()
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])
        if len(keys) and (keys[0], own[0]) == (key, last):
            fresh[0] = False
        keys, own = keys[fresh], own[fresh]
        if not len(keys):
            continue
        begins = np.ones(len(keys), dtype=bool)
        begins[1:] = keys[1:] != keys[:-1]
        begins[0] = keys[0] != key
        at = np.maximum.accumulate(np.where(begins, np.arange(len(keys)), -1))
        firsts = np.where(at >= 0, own[np.maximum(at, 0)], first if first is not None else 0)
        out = ~begins | np.append(~begins[1:], False)
        if alone and not begins[0]:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([last]), pa.array([first])], schema=schema)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(keys[out]), pa.array(own[out]), pa.array(firsts[out])], schema=schema)
        key, last, first, alone = int(keys[-1]), int(own[-1]), int(firsts[-1]), bool(begins[-1])


class Relations:
    """The sets of a task, and which of them are similar.

    Elements are ranked by how many sets hold them, the rare ones first; a set's
    position of an element is its place in that order.
    """

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent, self.sizes = percent, np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        _, inverse, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(held), dtype=np.int64)
        rank[np.argsort(held, kind="stable")] = np.arange(len(held))
        ranks = rank[inverse]
        order = np.lexsort((ranks, owner))
        self.ranks = ranks[order]  # of every set, rare elements first
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        position = np.arange(len(ranks)) - self.starts[owner]
        # Lists: by element, then by block of sizes.
        block = np.floor(np.log(self.sizes) / np.log(100 / percent if percent < 100 else 1.1)).astype(np.int64)
        lists = np.lexsort((block[owner], self.ranks))
        self.members, self.room = owner[lists], (self.sizes[owner] - position)[lists]
        list_rank, list_block = self.ranks[lists], block[owner][lists]
        cut = np.concatenate(([True], (list_rank[1:] != list_rank[:-1]) | (list_block[1:] != list_block[:-1])))
        self.block_starts = np.flatnonzero(cut)
        self.block_sizes = np.diff(np.append(self.block_starts, len(lists)))
        # The most room for a common rest that a member of the block has, and its sizes.
        self.block_room = np.maximum.reduceat(self.room, self.block_starts)
        self.block_low = np.minimum.reduceat(self.sizes[self.members], self.block_starts)
        self.block_high = np.maximum.reduceat(self.sizes[self.members], self.block_starts)
        self.first_block = np.searchsorted(list_rank[self.block_starts], np.arange(len(held) + 1))
        self.marks = np.zeros(len(held), dtype=bool)

    def own(self, x: int) -> np.ndarray:
        return self.ranks[self.starts[x] : self.starts[x + 1]]

    def slack(self, x: int) -> int:
        """Elements a set may lack of x, or have besides, to take over its answers."""
        return int(self.sizes[x]) // 20

    def scan(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        """All sets, and their overlaps with x, that x or a set within its slack may be similar to."""
        size, slack = int(self.sizes[x]), self.slack(x)
        least = max(1, -(-(size - slack) * self.percent // 100) - slack)
        most = largest(size + slack, self.percent)
        prefix = self.own(x)[: size - least + 1]
        begins = self.first_block[prefix]
        blocks = _ranges(begins, self.first_block[prefix + 1] - begins)
        blocks = blocks[(self.block_room[blocks] >= least) & (self.block_high[blocks] >= least) & (self.block_low[blocks] <= most)]
        entries = _ranges(self.block_starts[blocks], self.block_sizes[blocks])
        met = np.zeros(len(self.sizes), dtype=bool)
        met[self.members[entries[self.room[entries] >= least]]] = True
        met[x] = False
        found = np.flatnonzero(met & (self.sizes <= most))
        if not len(found):
            return found, found
        self.marks[self.own(x)] = True
        inside = self.marks[self.ranks[_ranges(self.starts[found], self.sizes[found])]]
        self.marks[self.own(x)] = False
        shared = np.add.reduceat(inside.astype(np.int64), np.cumsum(self.sizes[found]) - self.sizes[found])
        keep = shared >= least
        return found[keep], shared[keep]

    def held_by(self, elements: np.ndarray) -> np.ndarray:
        """Of every set, how many of some elements it has: from their lists alone."""
        begins, ends = self.first_block[elements], self.first_block[elements + 1]
        first = self.block_starts[begins]
        last = np.append(self.block_starts, len(self.members))[ends]
        return np.bincount(self.members[_ranges(first, last - first)], minlength=len(self.sizes))

    def derive(self, x: int, base: int, found: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """The overlaps of x with what was found for a base that differs little from it."""
        own, other = self.own(x), self.own(base)
        more = np.setdiff1d(own, other, assume_unique=True)
        less = np.setdiff1d(other, own, assume_unique=True)
        return shared + (self.held_by(more) - self.held_by(less))[found]

    def similar(self, x: int, found: np.ndarray, shared: np.ndarray) -> np.ndarray:
        union = self.sizes[x] + self.sizes[found] - shared
        return found[(100 * shared >= self.percent * union) & (found != x)]

    def answers(self) -> Iterator[tuple[int, np.ndarray]]:
        """Every set with all that are similar to it."""
        lender = np.full(len(self.sizes), -1)
        lent: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        for x in np.argsort(self.sizes, kind="stable").tolist():
            base = int(lender[x])
            if base < 0:
                found, shared = self.scan(x)
                slack = self.slack(x)
                near = (self.sizes[x] - shared <= slack) & (self.sizes[found] - shared <= slack)
                free = found[near & (lender[found] < 0)]
                lender[x] = x
                lender[free] = np.where(lender[free] < 0, x, lender[free])
                borrowers = int(len(free))
                if borrowers:  # the base itself is an answer of those that borrow
                    lent[x] = (np.append(found, x), np.append(shared, self.sizes[x]), borrowers)
                yield x, self.similar(x, found, shared)
            elif base != x:
                found, shared, left = lent[base]
                yield x, self.similar(x, found, self.derive(x, base, found, shared))
                if left == 1:
                    del lent[base]
                else:
                    lent[base] = (found, shared, left - 1)


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all similar sets of a task, none of which repeats what is joined."""
    if len(sets) < 2:
        return []
    forest, links = Forest(), []
    label = np.arange(len(sets))
    for x, found in Relations(sets, percent).answers():
        others = found[label[found] != label[x]]
        for y in others[np.unique(label[others], return_index=True)[1]].tolist():
            forest.union(x, y)
            links.append((x, y))
            label[(label == label[y])] = label[x]
    return links


def _linked(percent: int):
    """Rows (hub, block, id, elements) sorted by hub and block to links of each task."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in stream:
            lists = batch["elements"]
            values, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            for k, (hub, block, own) in enumerate(zip(*(batch[c].to_pylist() for c in ("hub", "block", "id")), strict=True)):
                if (hub, block) != key:
                    yield from _made(held, percent, schema)
                    key, held = (hub, block), {}
                held[own] = values[offsets[k] : offsets[k + 1]].copy()
        yield from _made(held, percent, schema)

    return run


def _made(held: dict[int, np.ndarray], percent: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    ids = list(held)
    links = spanning_links(list(held.values()), percent)
    if links:
        yield pa.RecordBatch.from_arrays([pa.array([ids[p[k]] for p in links], pa.int64()) for k in (0, 1)], schema=schema)


def _elements(shingle: int):
    """Rows (id, text) to (id, elements)."""
    schema = pa.schema([("id", pa.int64()), ("elements", pa.list_(pa.int64()))])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                own = list(shingle_sets(part["text"], shingle))
                offsets = np.cumsum([0, *map(len, own)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part["id"], lists], schema=schema)

    return run


def _links(tasks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of tasks (hub, block, id)."""
    rows = tasks.join(sets, "id").select("hub", "block", "id", "elements")
    dealt = rows.repartition("hub", "block").sortWithinPartitions("hub", "block")
    return written(dealt.mapInArrow(_linked(percent), "a long, b long"), "links")


def _tasks(pairs: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """(hub, block, id) of pairs (hub, id): what meets a hub, in blocks of ``most`` elements or so.

    The hub is in every block.
    """
    known = pairs.join(sizes, "id").select("hub", "id", "n")
    blocks = known.groupBy("hub").agg(F.ceil(F.sum("n") / most).alias("blocks"))
    dealt = known.join(blocks, "hub").select("hub", F.pmod(F.xxhash64("id"), "blocks").alias("block"), "id")
    hubs = blocks.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("hub").alias("id"))
    return dealt.unionByName(hubs)


def _open_pairs(percent: int):
    """Rows (key, task, block, id, n, label, hub, part), sorted by key and task, to pairs not yet compared."""
    schema = pa.schema([("hub", pa.int64()), ("id", pa.int64())])

    def pairs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        block, own, n, label, hub, part = (np.array(c) for c in zip(*rows, strict=True))
        two = len(np.unique(block)) > 1
        for k in range(len(own) - 1):
            rest = slice(k + 1, None)
            low, high = np.minimum(n[k], n[rest]), np.maximum(n[k], n[rest])
            keep = (label[rest] != label[k]) & (100 * low >= percent * high)
            keep &= ~((hub[rest] == hub[k]) & (part[rest] == part[k]))
            if two:
                keep &= block[rest] != block[k]
            if keep.any():
                others = own[rest][keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(others, own[k])), pa.array(np.maximum(others, own[k]))], schema=schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in stream:
            for first, task, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (first, task) != key:
                    if rows:
                        yield from pairs(rows)
                    key, rows = (first, task), []
                rows.append(tuple(row))
        if rows:
            yield from pairs(rows)

    return run


def similar_sets(docs: DataFrame, members: DataFrame, classes: DataFrame, percent: int, shingle: int, most: int = TASK, block: int = BLOCK) -> DataFrame:
    """(node, component) of the classes of equal sets that are joined to others.

    ``docs`` has row and text, ``members`` is lists (key, s1, first), ``classes``
    has id, row, n, s1 of every class.
    """
    met = members.groupBy("s1").agg(F.min("first").alias("first"))
    ids = classes.select("id", "row", "n", "s1")
    # Should two classes have one s1, either stands for it: they meet more than they must.
    own = written(ids.join(met, "s1"), "met")
    hubs = own.groupBy(F.col("s1").alias("first")).agg(F.min("id").alias("hub"))
    placed = own.join(hubs, "first").select("id", "row", "n", "s1", "hub")
    placed = written(placed, "placed")
    wanted = few(written(placed.select("row", "id"), "wanted"))
    sets = written(docs.join(wanted, "row").select("id", "text").mapInArrow(_elements(shingle), "id long, elements array<long>"), "sets")
    sizes = placed.select("id", "n")
    tasks = written(_tasks(placed.filter("id <> hub").select("hub", "id"), sizes, most), "tasks")
    links = _links(tasks, sets, percent)
    joined = components(links)
    # Lists that hold several components yet.
    part = tasks.filter("id <> hub").select("id", F.col("block").alias("part"))
    labelled = placed.join(joined, placed["id"] == joined["node"], "left").join(part, "id", "left")
    labelled = written(labelled.select("id", "n", "s1", "hub", F.coalesce("component", "id").alias("label"), F.coalesce("part", F.lit(-1).cast("long")).alias("part")), "labelled")
    named = written(members.select("key", "s1").join(labelled, "s1").drop("s1"), "named")
    lists = named.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("id").alias("first"), F.count(F.lit(1)).alias("size")
    )
    open_ = written(lists.filter("low < high").select("key", "first", "size"), "open")
    if open_.isEmpty():
        return joined
    again = _again(named, open_, sizes, percent, most, block)
    return components(links.unionByName(_links(again, sets, percent)))


def _again(named: DataFrame, open_: DataFrame, sizes: DataFrame, percent: int, most: int, block: int) -> DataFrame:
    """Tasks (hub, block, id) that compare what shares a list with members of several components.

    Sets that such lists connect are a family. Where its lists hold fewer pairs
    than a family has members, times its blocks of ``most`` elements, the pairs
    are listed; a crowded family is compared block by block instead, inside the tasks.
    """
    rows = named.join(open_, "key")
    families = components(rows.select(F.col("id").alias("a"), F.col("first").alias("b")))
    families = written(families.join(sizes, families["node"] == sizes["id"]).select("id", "n", F.col("component").alias("family")), "families")
    held = families.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.ceil(F.sum("n") / most).alias("blocks"))
    pairs = open_.join(families, open_["first"] == families["id"]).groupBy("family").agg(
        F.sum(F.col("size") * (F.col("size") - 1) / 2).alias("pairs")
    )
    crowded = written(held.join(pairs, "family").filter("pairs > members * blocks").select("family", "blocks"), "crowded")
    whole = families.join(crowded, "family").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    by_block = whole.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        (-1 - F.col("family")).alias("hub"),
        (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("block"),
        "id",
    )
    sparse = open_.join(families, open_["first"] == families["id"]).join(crowded, "family", "left_anti")
    cut = named.join(sparse.select("key", F.ceil(F.col("size") / block).alias("blocks")), "key")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    others = F.when(F.col("blocks") > 1, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.col("block")))
    met = cut.withColumn("other", F.explode(others)).select(
        "key", (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("task"), "block", "id", "n", "label", "hub", "part"
    )
    dealt = met.repartition("key", "task").sortWithinPartitions("key", "task")
    listed = written(dealt.mapInArrow(_open_pairs(percent), "hub long, id long").distinct(), "pairs")
    return written(_tasks(listed, sizes, most).unionByName(by_block), "again")


def near_duplicates(docs: DataFrame, percent: int = 90, shingle: int = 3) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents are linked if ``percent`` of the shingles of both are common,
    shingles being ``shingle`` words of a text, A-Z lower-cased, words runs of
    anything but ASCII white space; a text of fewer words is one shingle.
    component_id is the smallest doc_id that links reach, the document's own
    included. Null and empty texts, and texts of white space, have no shingle and
    no link. Shingles are known by 64 bits, sets by 128. Rows with a null or
    repeated doc_id each give a row; a null id is no candidate for component_id
    unless the component has no other. Other columns are ignored; an empty table
    gives an empty result.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, key = row_keys(own, "doc_id")
    rows = rows.select(F.col(key).alias("row"), "doc_id", "text")
    found = written(rows.mapInArrow(_sets(percent, shingle), SETS), "sets")
    classes = found.groupBy("n", "s1", "s2").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    entries = found.select(F.explode("keys").alias("key"), "s1")
    dealt = entries.repartition("key").sortWithinPartitions("key", "s1")
    members = written(dealt.mapInArrow(_lists, "key long, s1 long, first long"), "members")
    joined = similar_sets(rows.select("row", "text"), members, classes, percent, shingle)
    groups = classes.join(joined, classes["id"] == joined["node"], "left").select(
        "n", "s1", "s2", "least", F.coalesce("component", "id").alias("group")
    )
    least = groups.groupBy("group").agg(F.min("least").alias("component_id"))
    named = groups.join(least, "group").select("n", "s1", "s2", "component_id")
    whole = found.select("doc_id", "n", "s1", "s2").join(named, ["n", "s1", "s2"])
    alone = F.col("n") == 0
    return whole.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
