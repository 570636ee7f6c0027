"""Spelling variants of words by asymmetric chunks.

Of two words one edit apart, the shorter (or either, if they are as long) gives two
disjoint chunks that cover it, and the other gives grams of the same lengths at
the chunks' positions and one further on. One edit leaves one of the chunks
whole, moved by one position at most, so every pair meets in the list of a chunk.
Members of a list are verified character by character. A list that is too long
for a task is dealt out again: what stands beside the shared chunk must be one
edit apart too, so the same scheme applies to that rest.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import batches, few, slices, texts, written

RUN = re.compile("[a-zÀ-ÿ]+")
SLICE = 4 << 20
# Different words a task counts before it lets them go; members of a list one task
# compares; characters of a block of comparisons; times a list is dealt out again.
HELD, MOST, CELLS, LEVELS = 200_000, 20_000, 1 << 21, 4


def damaged(word: str, doc_id: int | None, every: int) -> str:
    """The word as the document writes it: of ``every`` words one lacks a character.

    The draw is the CRC-32 of ``<doc_id>:<word>``; a null doc_id is written as nothing.
    """
    draw = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if draw % every:
        return word
    at = draw % len(word)
    return word[:at] + word[at + 1 :]


def counts(docs: DataFrame, least: int = 7, often: int = 2, every: int = 0) -> DataFrame:
    """(word, n) of the words of ``least`` characters that occur ``often`` times or more.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z
    lower-cased. ``every`` above 0 takes a character from one in so many, see
    ``damaged``; lengths and counts are those of the result. Null and empty texts
    have no words, repeated rows count again, other columns are ignored.
    """
    schema = batches("word string, n long")

    def made(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], schema=schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    own = Counter(w for w in RUN.findall((text or "").encode().lower().decode()) if len(w) >= least)
                    if not every:
                        found.update(own)
                        continue
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in own.items():
                        draw = zlib.crc32(word.encode(), start)
                        if draw % every == 0:
                            at = draw % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        found[word] += n
                    if len(found) >= HELD:
                        yield made(found)
                        found = Counter()
        if found:
            yield made(found)

    total = texts(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") >= often)


def _entries(rest: Column, key: Column) -> Column:
    """List entries of a word: two chunks, and the grams that chunks of a shorter one may be.

    ``rest`` is the part of the word that no shared chunk covers yet and ``key``
    stands for what it covers. ``longer`` tells the grams of the longer word.
    """
    size = F.length(rest)

    def entry(short: Column, part: int, at: Column, longer: bool) -> Column:
        half = F.floor(short / 2).cast("int")
        start = at if part == 0 else half + at
        width = half if part == 0 else short - half
        left = F.substring(rest, start + width + 1, size) if part == 0 else F.substring(rest, F.lit(1), start)
        return F.struct(
            F.xxhash64(key, short, F.lit(part), F.substring(rest, start + 1, width)).alias("key"),
            F.lit(longer).alias("longer"),
            # A moved gram leaves nothing to compare again: the whole scheme finds such pairs unmoved.
            F.when(at == (part if longer else 0), left).alias("rest"),
        )

    own = [entry(size, part, F.lit(0), False) for part in (0, 1)]
    grams = [entry(size - 1, part, F.lit(at), True) for part in (0, 1) for at in (0, 1)]
    return F.when(size > 0, F.array(*own, *grams)).otherwise(F.array(*own))


def replaced(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, of as many characters, that differ in exactly one."""
    return _compared(codes, codes, lambda one, other: np.count_nonzero(one != other, axis=2) == 1, True)


def inserted(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of which the second has exactly one character more."""
    size = short.shape[1]

    def near(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        before = np.logical_and.accumulate(one == other[:, :, :size], axis=2).sum(axis=2)
        after = np.logical_and.accumulate((one == other[:, :, 1:])[:, :, ::-1], axis=2).sum(axis=2)
        return before + after >= size

    return _compared(short, long, near, False)


def _compared(one: np.ndarray, other: np.ndarray, near, same: bool) -> tuple[np.ndarray, np.ndarray]:
    step = max(1, isqrt(CELLS // max(1, other.shape[1])))
    a, b = [], []
    for i in range(0, len(one), step):
        for j in range(i if same else 0, len(other), step):
            x, y = np.nonzero(near(one[i : i + step, None, :], other[None, j : j + step, :]))
            x, y = x + i, y + j
            keep = x < y if same else slice(None)
            a.append(x[keep])
            b.append(y[keep])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def _codes(words: list[str]) -> np.ndarray:
    """Words of as many characters as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def list_pairs(words: list[str], longer: list[bool]) -> Iterator[tuple[int, int]]:
    """Places of the near pairs of a list: among its chunk words, and between them and the longer ones.

    Words of other lengths got into the list by a clash of its hash; they meet their own kind only.
    """
    own: dict[int, list[int]] = {}
    grams: dict[int, list[int]] = {}
    for place, (word, long) in enumerate(zip(words, longer, strict=True)):
        (grams if long else own).setdefault(len(word), []).append(place)
    for size, places in own.items():
        codes = _codes([words[p] for p in places])
        for x, y in zip(*replaced(codes), strict=True):
            yield places[x], places[y]
        if others := grams.get(size + 1):
            for x, y in zip(*inserted(codes, _codes([words[p] for p in others])), strict=True):
                yield places[x], others[y]


def _verified(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, word, n, longer) sorted by key to near pairs, each in both directions."""
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
    key, words, ns, longer = None, [], [], []
    out: list[tuple] = []

    def close() -> None:
        if len(words) > 1 and not all(longer):
            for x, y in list_pairs(words, longer):
                out.extend(((words[x], words[y], ns[y]), (words[y], words[x], ns[x])))

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for batch in stream:
        for row in zip(*(batch[c].to_pylist() for c in ("key", "word", "n", "longer")), strict=True):
            if row[0] != key:
                close()
                key, words, ns, longer = row[0], [], [], []
                if len(out) > 10_000:
                    yield made()
                    out = []
            words.append(row[1])
            ns.append(row[2])
            longer.append(row[3])
    close()
    if out:
        yield made()


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, near, near_n): each two words of (word, n) that are one edit apart, in both directions.

    An edit inserts, deletes or replaces one character. Words are distinct and not
    null. Lists of over ``most`` members are dealt out again by what their members
    do not share yet, ``LEVELS`` times at most; by then as much as 15/16 of a word is shared.
    """
    entries = words.select("word", "n", F.inline(_entries(F.col("word"), F.lit(0))))
    for _ in range(LEVELS):
        sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        long = written(sizes.filter(F.col("size") > most).select("key"), "long")
        if long.isEmpty():
            break
        # The long lists are known by rows / most keys.
        again = entries.join(few(long), "key").filter("rest IS NOT NULL").withColumnRenamed("rest", "left_")
        # A longer word joins the shorter ones' lists only, and they join the longer ones' grams.
        chunks = again.select("word", "n", F.col("longer").alias("was"), F.inline(_entries(F.col("left_"), F.col("key"))))
        chunks = chunks.filter("longer = was").drop("was")
        entries = written(entries.join(few(long), "key", "left_anti").select(*chunks.columns).unionByName(chunks), "entries")
    dealt = entries.select("key", "word", "n", "longer").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_verified, "word string, near string, near_n long").distinct()


def forms(words: DataFrame, near: DataFrame, times: int = 10) -> DataFrame:
    """(word, n_near, form, form_n) of every word that has near ones.

    The form is the near word with the largest n, of equal ones the first in
    code-point order, if it occurs ``times`` as often as the word; else null.
    """
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    often = -F.col("best.less") >= times * F.col("n")
    return words.join(best, "word").select(
        "word",
        "n_near",
        F.when(often, F.col("best.form")).alias("form"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last form that forms lead to, of (word, form) without loops.

    Every round doubles the hops that are followed; a form is ``times`` as frequent
    as its word, so there are few.
    """
    found = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("middle"), F.col("root").alias("last"))
        joined = found.join(further, found["root"] == further["middle"], "left")
        following = written(joined.select("word", F.coalesce("last", "root").alias("root"), F.col("middle").isNotNull().alias("moved")), "roots")
        found = following.drop("moved")
        if following.filter("moved").isEmpty():
            return found


def variants(words: DataFrame, times: int = 10, most: int = MOST) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the far more frequent word one edit apart (see ``forms``), ``root``
    the last that forms lead to, the word itself if it has none; n_near counts
    the words one edit apart. An empty table gives an empty result.
    """
    words = written(words.select("word", "n"), "words")
    known = written(forms(words, near_words(words, most), times), "forms")
    last = roots(known.filter("form IS NOT NULL"))
    return (
        words.join(known, "word", "left")
        .join(last, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )
