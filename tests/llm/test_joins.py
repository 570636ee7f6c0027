"""The trie, the set join and the spelling variants against brute force, and their edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from oracle import compare, database
from pyspark.sql import functions as F

from ludometry.llm import jaccard, oracles, queries, trie, variants
from ludometry.llm.base import table

SF = "/root/testdata/sf0.001"
NEW = ("op11_trie", "op12_jaccard", "op13_variants")


@pytest.mark.parametrize("name", NEW)
def test_queries_equal_their_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), database(SF), oracles_of(name)) == ""


def oracles_of(name):
    return {"op11_trie": oracles.TRIE, "op12_jaccard": oracles.JACCARD, "op13_variants": oracles.VARIANTS}[name]


# Conversations


def conversation_rows(seed, n=120):
    """Shared beginnings, copies, ids apart and below zero, nulls, ties and repeated rows."""
    draw = random.Random(seed)
    rows = []
    for c in [*range(n), -7, -40, 10**12]:
        length = draw.choice([1, 1, 2, 3, 4, 7])
        for turn in range(length):
            text = draw.choice(["", None, "a b", "a  b\tc", "ü x y", f"only {c}"]) if turn else draw.choice(["hi", "ho there"])
            rows.append((c, turn if draw.random() < 0.95 else None, draw.choice(["user", None, "bot"]), text))
    rows.append(rows[5])
    rows.append((None, 0, "user", "nobody's"))
    return rows


def nodes_by_hand(rows, every=20):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(found, key=lambda x: x[0])] for c, found in turns.items()}
    rebuilt = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, every))
        rebuilt[c] = own.get(base, [])[:h] + found[h:]
    members = defaultdict(list)
    for c, found in rebuilt.items():
        for d in range(len(found) + 1):
            members[tuple(found[:d])].append(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)

    def words(path):
        return len(path[-1][1].encode().split()) if path else 0

    def below(path):
        yield path
        for child in children[path]:
            yield from below(child)

    out = []
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(rebuilt[c]) == len(path))
        under = list(below(path))
        out.append((
            min(found), len(path), min(members[path[:-1]]) if path else None, len(found), len(children[path]),
            sum(not children[p] for p in under), sum((len(members[p]) - 1) * words(p) for p in under),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt_of(frame):
    conv = F.col("conv_id")
    return trie.with_heads(trie.turns_of(frame), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, most=3)


@pytest.mark.parametrize("most, turns", [(2_048, 65_536), (3, 10), (1, 1)])
def test_trie_equals_every_prefix_by_hand_for_any_shards(spark, most, turns):
    rows = conversation_rows(most)
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, node int, shard int")
    found = trie.trie(rebuilt_of(frame.repartition(5)), most, turns).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=repr) == nodes_by_hand(rows)


def test_one_conversation_that_all_others_copy(spark):
    rows = [(c, turn, "user", f"turn {turn}") for c in range(500) for turn in range(3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    local = trie.local_nodes(trie.turns_of(frame), most=16)
    found = {r.depth: r for r in trie.nodes(local).collect()}
    assert [found[d].n_convs for d in range(4)] == [500] * 4
    assert [found[d].saved_tokens for d in range(4)] == [499 * 6, 499 * 6, 499 * 4, 499 * 2]
    ends = trie.end_lists(local).orderBy("shard").collect()
    assert len(ends) >= 500 // 16
    assert [c for r in ends for c in r.ends] == list(range(500))
    assert trie.end_digests(local).first().ends_sha256 == hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()


def test_conversations_left_without_a_turn_end_at_the_root(spark):
    rows = [(c, 0, "user", "x") for c in range(21, 39)]  # their base, 20, is absent
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    root = trie.trie(rebuilt_of(frame)).filter("depth = 0").first()
    gone = [c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4]
    assert root.n_convs == 18
    assert root.ends_sha256 == hashlib.sha256(",".join(map(str, gone)).encode()).hexdigest()


def test_long_conversations_and_none(spark):
    rows = [(1, turn, "user", f"{turn} " * 3) for turn in range(3_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = trie.trie(trie.turns_of(frame), turns=100)
    assert made.count() == 3_001
    assert made.agg(F.sum("n_leaves")).first()[0] == 3_001
    assert trie.trie(rebuilt_of(frame.filter("false"))).collect() == []


# Sets


def shingles_by_hand(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    if len(words) < size:
        return {b" ".join(words)}
    return {b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)}


def components_by_hand(rows, percent=90):
    sets = [shingles_by_hand(text) for _, text in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            shared = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                group[find(x)] = find(y)
    least = {}
    for x, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(x)] = min(least.get(find(x), doc_id), doc_id)
    return sorted(((doc_id, len(sets[x]), least.get(find(x)) if sets[x] else doc_id) for x, (doc_id, _) in enumerate(rows)), key=repr)


def near_copies(seed, families=12, copies=14):
    """Families of texts of all sizes, whose copies have more or fewer words replaced, added or gone."""
    draw = random.Random(seed)
    rows = []
    for family in range(families):
        size = draw.choice([3, 9, 11, 12, 17, 19, 20, 21, 22, 40, 90, 250])
        text = [f"w{draw.randrange(10**6)}" for _ in range(size)]
        for _ in range(copies):
            own = list(text)
            for _ in range(draw.choice([0, 0, 1, 1, 1, 2, size // 60, size // 25, size // 12])):
                at = draw.randrange(len(own))
                kind = draw.random()
                if kind < 0.3:
                    own[at] = f"n{draw.randrange(10**6)}"
                elif kind < 0.6:
                    own.insert(draw.choice([0, at, len(own)]), f"n{draw.randrange(10**6)}")
                elif kind < 0.8 and len(own) > 1:
                    own.pop(draw.choice([0, at, len(own) - 1]))
                else:
                    own = own[at:] + own[:at]
            rows.append((len(rows), " ".join(own)))
    draw.shuffle(rows)
    return rows


def found_by(frame, percent=90):
    return sorted((tuple(r) for r in jaccard.near_duplicates(frame, percent).collect()), key=repr)


def test_sets_equal_all_pairs_by_hand(spark):
    rows = near_copies(1) + [(1_000, None), (1_001, ""), (1_002, " \t\n"), (1_003, "One two"), (1_004, "one  TWO"), (1_005, "ONE")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int").repartition(7)
    assert found_by(frame) == components_by_hand(rows)
    assert found_by(frame, 75) == components_by_hand(rows, 75)


def test_sets_with_null_and_repeated_ids(spark):
    rows = near_copies(2, families=4)
    rows = [(None if k % 5 == 0 else doc_id // 2, text) for k, (doc_id, text) in enumerate(rows)]
    frame = spark.createDataFrame(rows + rows[:9], "doc_id long, text string")
    assert found_by(frame) == components_by_hand(rows + rows[:9])
    assert found_by(frame.filter("false")) == []


def test_sets_in_small_tasks_and_blocks(spark, monkeypatch):
    """Hubs, lists and tasks that are cut into many blocks give the same."""
    monkeypatch.setattr(jaccard.similar_sets, "__defaults__", (60, 3))
    rows = near_copies(3, families=6, copies=40)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_by(frame) == components_by_hand(rows)


def test_every_similar_pair_shares_a_list():
    """Also where one set has too few rich parts, and across classes of sizes."""
    draw = np.random.default_rng(5)
    keys = jaccard.Keys(90)
    for size in [*range(1, 60), 70, 99, 130, 400, 1_000]:
        for _ in range(6):
            own = np.unique(draw.integers(0, 1 << 64, size, dtype=np.uint64))
            if draw.random() < 0.3:  # crowded into few parts
                own = np.unique(own >> np.uint64(int(draw.integers(1, 30))))
            most = jaccard.differences(2 * size + size // 9, 90)
            less = int(draw.integers(0, most + 1)) if most else 0
            more = int(draw.integers(0, most - less + 1))
            other = np.unique(np.append(draw.permutation(own)[: size - less], draw.integers(0, 1 << 64, more, dtype=np.uint64)))
            shared = len(np.intersect1d(own, other))
            if np.array_equal(own, other) or 100 * shared < 90 * (len(own) + len(other) - shared):
                continue
            assert np.intersect1d(keys(own), keys(other)).size, (size, less, more)


def test_relations_equal_all_pairs():
    draw = np.random.default_rng(6)
    for percent in (90, 80):
        base = [draw.integers(0, 1 << 64, int(n), dtype=np.uint64) for n in (12, 40, 41, 200, 600)]
        sets = []
        for own in base:
            for _ in range(25):
                gone = int(draw.integers(0, len(own) // 6 + 1))
                sets.append(np.unique(np.append(draw.permutation(own)[gone:], draw.integers(0, 1 << 64, int(draw.integers(0, len(own) // 8 + 1)), dtype=np.uint64))))
        relations = jaccard.Relations(sets, percent)
        answers = {x: set(found.tolist()) for x, found in relations.answers()}
        derived = 0
        for x, own in enumerate(sets):
            overlap = [len(np.intersect1d(own, other)) for other in sets]
            similar = {y for y, o in enumerate(overlap) if y != x and 100 * o >= percent * (len(own) + len(sets[y]) - o)}
            assert answers[x] == similar
            derived += bool(similar)
        assert derived


def test_hashes_of_long_texts_cross_pieces(monkeypatch):
    text = " ".join(f"Ärger{k}" for k in range(3_000)) + " " + "x" * 5_000 + " tail"
    whole = next(jaccard.shingle_sets(pa.array([text])))
    monkeypatch.setattr(jaccard, "PIECE", 1_000)
    assert np.array_equal(next(jaccard.shingle_sets(pa.array([text]))), whole)
    assert len(whole) == 3_000
    lowered = next(jaccard.shingle_sets(pa.array([text.replace("Ärger", "ÄRGER")])))
    assert np.array_equal(lowered, whole)


def test_text_of_many_megabytes(spark):
    text = " ".join(f"term{k * 7919}" for k in range(500_000))
    rows = [(1, text), (2, text + " and more"), (3, "before " + text), (4, text[: len(text) // 2])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_by(frame) == components_by_hand(rows)


# Words


def edits(word, letters):
    for k in range(len(word) + 1):
        for c in letters:
            yield word[:k] + c + word[k:]
            if k < len(word):
                yield word[:k] + c + word[k + 1 :]
        if k < len(word):
            yield word[:k] + word[k + 1 :]


def variants_by_hand(counts, times=10):
    letters = {c for w in counts for c in w}
    near = {w: {x for x in edits(w, letters) if x in counts and x != w} for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else counts[form[w]]))
    return sorted(out, key=repr)


def crowded_words(seed, n=400):
    draw = random.Random(seed)
    words = {"abcabca", "ßàÀÿ×÷é"}
    while len(words) < n:
        word = "".join(draw.choice("abü") for _ in range(draw.choice([7, 7, 8, 9, 10])))
        words |= {word, draw.choice(list(edits(word, "abü")))}
    return {w: draw.choice([2, 3, 20, 25, 200, 250, 2_500]) for w in sorted(words) if len(w) >= 7}


@pytest.mark.parametrize("most", [20_000, 12, 2])
def test_variants_equal_all_edits_by_hand_for_any_length_of_lists(spark, most):
    counts = crowded_words(most)
    frame = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, key int")
    found = variants.variants(frame, most=most).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted((tuple(r) for r in found), key=repr) == variants_by_hand(counts)


def counts_by_hand(rows, every):
    found = Counter()
    for doc_id, text in rows:
        for run in variants.RUN.findall("".join(c.lower() if c < "\x80" else c for c in text or "")):
            word = variants.damaged(run, doc_id, every) if every else run
            if len(word) >= 7:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= 2}


@pytest.mark.parametrize("every", [0, 3])
def test_words_are_counted_and_damaged(spark, every):
    long = "ab" * 40_000
    text = "Example EXAMPLE exämple ÉXAMPLE_example2example 'abcdefg' abcdefĀabcdefgh×÷ " + long
    rows = [(k, text) for k in range(40)] + [(None, text), (7, text), (8, ""), (9, None), (-1, "12 !!")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, word int")
    found = variants.counts(frame, every=every)
    assert {r.word: r.n for r in found.collect()} == counts_by_hand(rows, every)
    assert variants.variants(found).count() == len(counts_by_hand(rows, every))


def test_many_words_leave_a_task_in_parts(spark, monkeypatch):
    rows = [(k, " ".join(f"word{chr(97 + j % 26)}{chr(97 + k % 26)}{chr(97 + j // 26)}" for j in range(100))) for k in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = variants.counts(frame, least=7, often=1)
    assert {r.word: r.n for r in found.collect()} == {w: n for w, n in Counter(x for _, t in rows for x in t.split()).items()}


def test_forms_are_followed_over_many_hops(spark):
    links = [(f"w{k:02d}", f"w{k + 1:02d}") for k in range(18)]
    found = variants.roots(spark.createDataFrame(links, "word string, form string")).collect()
    assert {tuple(r) for r in found} == {(w, "w18") for w, _ in links}


def test_ties_take_the_first_in_code_point_order(spark):
    counts = {"abcdefg": 2, "abcdefh": 30, "abcdefé": 30, "abcdefZ".lower() + "x": 30}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    own = {r.word: r for r in variants.variants(frame).collect()}["abcdefg"]
    assert (own.form, own.form_n) == ("abcdefh", 30)


def test_no_word_at_all(spark):
    docs = table(spark, SF, "documents").filter("false")
    assert variants.variants(variants.counts(docs)).collect() == []
