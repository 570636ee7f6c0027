"""Whole results against plain loops: chunks, lines, scores, long texts; and names that clash."""

import hashlib
import math
import random

import numpy as np
import pytest

from ludometry.llm import chunks, contamination, language, lines, simhash, suffixes, toxicity
from ludometry.llm.base import fresh_name, numbered, row_keys, table

SF = "/root/testdata/sf0.001"


def corpus(spark, n=60):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").orderBy("doc_id").limit(n).collect()]
    return rows + [(10_001, None), (10_002, ""), (10_003, "ab"), (10_004, rows[3][1]), (10_005, "ab")]


def joined(ranges):
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def digest_row(doc_id, data, spans):
    kept, at = b"", 0
    for a, b in spans:
        kept, at = kept + data[at:a], b
    kept += data[at:]
    return doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


def chunks_by_hand(rows):
    """Chunks as the gear hash cuts them, a byte at a time; all but the first of equal ones go."""
    gear = [int(x) for x in chunks.GEAR]
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        rolled, ends, zero = 0, [], None
        for k, byte in enumerate(data):
            rolled = (rolled << 1) + gear[byte] & 0xFFFFFFFF
            if rolled >> 32 - chunks.BITS == 0:
                if zero is None or k - zero > chunks.APART:
                    ends.append(k + 1)
                zero = k
        if data and ends[-1:] != [len(data)]:
            ends.append(len(data))
        gone = []
        for a, b in zip([0, *ends], ends, strict=False):
            chunk = hashlib.md5(data[a:b]).digest()
            if chunk in seen:
                gone.append((a, b))
            seen.add(chunk)
        spans = [(a, b) for a, b in joined(gone) if b - a >= chunks.LEAST or b - a == len(data)]
        out.append(digest_row(doc_id, data, spans))
    return sorted(out)


def long_text(seed, size=4_300_000):
    draw = random.Random(seed)
    words = [f"{draw.randrange(10**9):x}" for _ in range(size // 8)]
    return " ".join(words)


@pytest.fixture(scope="module")
def long_rows():
    first = long_text(1)
    # A passage that crosses every edge of a buffer, again elsewhere and in another text.
    return [(1, first), (2, "own words before " + first[500_000:1_700_000] + " and after"), (3, long_text(2, 4_000) + first[2_097_000:2_097_900])]


def test_chunks_equal_a_byte_by_byte_loop(spark, long_rows):
    for rows in (corpus(spark), long_rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert sorted(map(tuple, chunks.dedup(frame).collect())) == chunks_by_hand(rows)


def suffixes_by_hand(rows, length=100):
    """Every window of every text by an odd polynomial of its own, its first place found by sorting."""
    texts = [(doc_id, np.frombuffer((text or "").encode(), dtype=np.uint8)) for doc_id, text in sorted(rows)]
    hashes, owner, place = [], [], []
    for k, (_, data) in enumerate(texts):
        if len(data) >= length:
            own = np.zeros(len(data) - length + 1, dtype=np.uint64)
            for step in range(length):
                own = own * np.uint64(6364136223846793005) + data[step : len(data) - length + 1 + step] + np.uint64(1)
            hashes.append(own)
            owner.append(np.full(len(own), k))
            place.append(np.arange(len(own)))
    hashes, owner, place = (np.concatenate(x) for x in (hashes, owner, place))
    first = np.zeros(len(hashes), dtype=bool)
    first[np.unique(hashes, return_index=True)[1]] = True
    out = []
    for k, (doc_id, data) in enumerate(texts):
        again = place[(owner == k) & ~first].tolist()
        out.append(digest_row(doc_id, data.tobytes(), joined((a, a + length) for a in again)))
    return sorted(out)


def test_suffixes_of_long_texts_equal_all_windows(spark, long_rows):
    frame = spark.createDataFrame(long_rows, "doc_id long, text string")
    assert sorted(map(tuple, suffixes.dedup(frame).collect())) == suffixes_by_hand(long_rows)


def test_line_digests_equal_the_texts_that_are_left(spark):
    rows = corpus(spark, 150)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r for r in lines.deduplicated(frame).collect()}
    for row in lines.digests(frame).collect():
        own = kept[row.doc_id]
        assert row.kept_sha256 == hashlib.sha256((own.text or "").encode()).hexdigest()
        assert (row.n_lines, row.n_removed, row.removed) == (own.n_lines, own.n_removed, own.removed)
        gone = {r.line for r in own.removed}
        text = dict(rows)[row.doc_id]
        assert own.text == (text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))


def lines_by_hand(rows, least=0.8):
    """Components of all pairs of different lines, by Python sets of shingles."""
    places = {}
    for doc_id, text in sorted(rows):
        for k, line in lines._lines(text or ""):
            places.setdefault(line, []).append((doc_id, k))
    names = list(places)
    sets = [lines.shingle_set(x) for x in names]
    group = list(range(len(names)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(names)):
        for y in range(x):
            if len(sets[y]) * least <= len(sets[x]) <= len(sets[y]) / least and lines.jaccard(sets[x], sets[y]) >= least:
                group[find(x)] = find(y)
    first = {}
    for x, name in enumerate(names):
        first[find(x)] = min(first.get(find(x), places[name][0]), places[name][0])
    return {(doc_id, k): first[find(x)] for x, name in enumerate(names) for doc_id, k in places[name] if (doc_id, k) != first[find(x)]}


def test_lines_equal_all_pairs(spark):
    draw = random.Random(9)
    base = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(draw.choice([2, 4, 9, 30]))) for _ in range(12)]
    rows = []
    for doc_id in range(40):
        own = []
        for _ in range(6):
            line = list(draw.choice(base))
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                line[draw.randrange(len(line))] = draw.choice("xyz")
            own.append("".join(line))
        rows.append((doc_id, "\n".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {(r.doc_id, x.line): (x.first_doc, x.first_line) for r in lines.deduplicated(frame).collect() for x in r.removed}
    assert found == lines_by_hand(rows)


def test_a_pair_is_compared_in_its_first_bucket_only():
    text = ["some line that stands for others", "some line that stands for other", "another line altogether, far off"]
    keys, shingles = list(lines.band_keys(text)), lines.shingles_of(text)
    first = int((keys[0] == keys[1]).argmax())
    for n in (2, 3):
        for column in range(lines.BANDS):
            found = lines.linked_pairs(list(range(n)), [0] * n, keys[:n], shingles[:n], column, 0.8)
            assert {frozenset(pair) for pair in found} == ({frozenset((0, 1))} if column == first else set())
    assert [len(set(s.tolist())) for s in shingles] == [len(lines.shingle_set(x)) for x in text]


def test_number_signs_are_no_letters(spark):
    rows = [(1, "½ ² ①"), (2, "Ⅳ Ⅸ ٣"), (3, "the 2nd ½ of this and that with those"), (4, "一 二"), (5, None)]
    docs = table(spark, SF, "documents")
    found = {r.doc_id: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string"), language.train(docs)).collect()}
    assert {found[k].lang_pred for k in (1, 2, 5)} == {"und"}
    assert found[3].lang_pred != "und" and found[4].lang_pred != "und"
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in found.values())


@pytest.mark.parametrize("bits", [5, 0])
def test_scores_of_copies_and_their_order_do_not_matter(spark, bits):
    """A text's score depends on the text alone, however rows lie and whatever is beside it."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels)
    names = language.train(docs)
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").limit(40).collect()] + [(900, None), (901, "")]
    alone = spark.createDataFrame(texts, "doc_id long, text string").repartition(1 + bits)
    twice = spark.createDataFrame([(k + 10_000 * j, t) for k, t in reversed(texts) for j in range(2)], "doc_id long, text string").coalesce(1)
    for predict, own, column in ((toxicity.predict, model, "score"), (language.predict, names, "score")):
        first = {r.doc_id: r[column] for r in predict(alone, own).collect()}
        again = {r.doc_id: r[column] for r in predict(twice, own).collect()}
        assert all(math.isclose(again[k + 10_000 * j], score, rel_tol=1e-9, abs_tol=1e-12) for k, score in first.items() for j in range(2))


def test_names_clash_whatever_their_case(spark, tmp_path):
    rows = [(1, "one text of some words here", 77, 1), (1, "one text of some words here", 78, 2), (None, "a text of its own kind", 79, 3), (2, None, 80, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `_ROW` int, `_Place` int")
    assert fresh_name(frame) == "_row_"
    for made, name in (numbered(frame, "doc_id", "text"), row_keys(frame, "doc_id")):
        assert sorted(r["_ROW"] for r in made.collect()) == [77, 78, 79, 80]
        assert len({r[name] for r in made.collect()}) == 4
    items = spark.createDataFrame([(1, "no item of five words is in any of these")], "item_id long, text string")
    for left, kept in (
        (lines.cleaned(frame), 4), (simhash.keep_one(frame), 3), (contamination.clean_rows(frame, items), 4),
    ):
        found = left.collect()
        assert left.columns == frame.columns and len(found) == kept
        assert {r["_ROW"] for r in found} <= {77, 78, 79, 80} and all(r["_ROW"] - 76 == r["_Place"] for r in found)


def test_numbers_follow_the_key_and_the_text(spark):
    rows = [(3, "b"), (None, "z"), (3, "a"), (None, None), (1, "x"), (3, "a")]
    made, name = numbered(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "doc_id", "text")
    assert [(r.doc_id, r.text) for r in made.orderBy(name).collect()] == [(None, None), (None, "z"), (1, "x"), (3, "a"), (3, "a"), (3, "b")]
