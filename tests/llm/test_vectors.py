"""Nearest neighbours against brute force: few vectors, repeated ids, vectors far from the rest."""

import numpy as np
import pytest

from ludometry.llm import vectors
from ludometry.llm.base import table

SCHEMA = "vec_id long, embedding array<double>, row int, node int"


def by_hand(rows, every=100, most=10):
    """(query_id, rank, vec_id, score) of every query row."""
    good = [(k, i, np.array(v, float)) for k, (i, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for k, i, v in good:
        if i is None or i % every:
            continue
        with np.errstate(over="ignore"):
            found = [(float(np.sqrt(((w - v) ** 2).sum())), j is None, j or 0, j) for n, j, w in good if n != k and len(w) == len(v)]
        found.sort(key=lambda x: x[:3])
        out.extend((i, r, j, s) for r, (s, _, _, j) in enumerate(found[:most], 1))
    return sorted(out, key=repr)


def found_by(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)
    return sorted(map(tuple, vectors.nearest(frame, settings=vectors.Settings(**settings)).collect()), key=repr)


def drawn(n, dims=8, seed=3):
    return [(k, row.tolist()) for k, row in enumerate(np.random.default_rng(seed).normal(size=(n, dims)))]


@pytest.mark.parametrize("n, dims", [(1, 2), (2, 2), (3, 8), (11, 8), (15, 8), (50, 8)])
def test_few_vectors_give_all_candidates(spark, n, dims):
    rows = drawn(n, dims)
    assert found_by(spark, rows) == by_hand(rows)


def test_rows_of_one_id_are_told_apart(spark):
    rows = drawn(30)
    rows += [(0, rows[7][1]), (0, rows[0][1]), (100, rows[0][1]), (None, rows[3][1]), (None, None), (200, [0.0] * 8), (300, [float("nan")] * 8), (400, [None, 1.0])]
    assert found_by(spark, rows) == by_hand(rows)


def test_a_hot_id_fills_several_shards(spark):
    rows = [(100, v) for _, v in drawn(60)] + [(k + 1, v) for k, (_, v) in enumerate(drawn(40, seed=4))]
    assert found_by(spark, rows, shard_rows=16) == by_hand(rows)


def recall(found, exact):
    """Share of the exact scores of each query that were found."""
    near = {}
    for query, _, _, score in exact:
        near.setdefault(query, []).append(score)
    hits = sum(score <= max(near[query]) * (1 + 1e-12) for query, _, _, score in found)
    return hits / len(exact)


def test_a_vector_far_from_the_rest_spoils_nothing(spark):
    rows = drawn(1_500, 16)
    rows[7] = (7, [1e25] * 16)
    rows[100] = (100, (np.array(rows[100][1]) * 1e25).tolist())
    found, exact = found_by(spark, rows), by_hand(rows)
    assert recall(found, exact) >= 0.9
    assert len({(q, v) for q, _, v, _ in found}) == len(found) == len(exact)


def test_no_node_is_met_twice():
    own = np.random.default_rng(5).normal(size=(2_000, 8))
    neighbours, entry = vectors.build_graph(own, vectors.Settings())
    for row in neighbours:
        kept = row[row >= 0]
        assert len(set(kept.tolist())) == len(kept)
    targets = np.random.default_rng(6).normal(size=(300, 8))
    met, _ = vectors.beam_search(own, neighbours, entry, targets, 96)
    assert all(len(set(row.tolist())) == 96 for row in met)
    nearest = np.argsort(((own[None] - targets[:, None]) ** 2).sum(axis=2), axis=1)[:, :10]
    assert np.mean([len(set(a.tolist()) & set(b[:10].tolist())) / 10 for a, b in zip(nearest, met, strict=True)]) >= 0.9


def test_recall_on_the_given_table(spark):
    rows = [(r.vec_id, None if r.embedding is None else list(map(float, r.embedding))) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    found = sorted(map(tuple, vectors.nearest(table(spark, "/root/testdata/sf0.1", "embeddings")).collect()), key=repr)
    exact = by_hand(rows)
    assert len(found) == len(exact)
    assert recall(found, exact) >= 0.95
