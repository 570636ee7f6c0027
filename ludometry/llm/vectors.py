"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors are dealt into shards of bounded size by a hash of their row. In a shard,
greedy beam searches from an entry point propose neighbours for each vector, and
robust pruning keeps those that no kept one is closer to by the factor alpha.
Every shard is searched by every query, and the best of all shards remain; a shard
of no more nodes than a beam holds is searched whole. Equal vectors of a shard are
one node that carries the smallest ids, as many as a result can hold, so copies
cannot crowd a graph or a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludometry.llm.base import batches, row_keys, written

# A node's ids and rows are those of its copies, the smallest first.
INDEX = (
    "shard long, dims int, node int, ids array<long>, rows array<long>, entry boolean, "
    "vector array<double>, neighbours array<int>"
)
FOUND = "query_row long, query_id long, row long, vec_id long, score double"


@dataclass(frozen=True)
class Settings:
    """Out-degree, beam of building and of searching, pruning factor, rows of a shard."""

    degree: int = 32
    build_beam: int = 64
    search_beam: int = 96
    alpha: float = 1.2
    shard_rows: int = 4096


def _distances(vectors: np.ndarray, nodes: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Squared distances of each target to its row of nodes.

    By differences and not by norms, which cancel where vectors are close.
    """
    apart = vectors[nodes]
    apart -= targets[:, None, :]
    return np.einsum("bkd,bkd->bk", apart, apart)


def beam_search(
    vectors: np.ndarray, neighbours: np.ndarray, entry: int, targets: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each target the ``beam`` nearest nodes met, nearest first, and distances.

    All targets take a step at a time: the nearest node not yet expanded gives
    its neighbours; the best of old and new remain. Rows of ``neighbours`` hold a
    node once at most, and -1 for none.
    """
    count, rows = len(vectors), len(targets)
    nodes = np.full((rows, beam), -1, dtype=np.int32)
    far = np.full((rows, beam), np.inf)
    done = np.zeros((rows, beam), dtype=bool)
    seen = np.zeros((rows, count), dtype=bool)
    nodes[:, 0] = entry
    far[:, 0] = _distances(vectors, nodes[:, :1], targets)[:, 0]
    seen[:, entry] = True
    live = np.arange(rows)
    while True:
        open_ = np.where(done[live] | (nodes[live] < 0), np.inf, far[live])
        at = open_.argmin(axis=1)
        going = np.isfinite(open_[np.arange(len(live)), at])
        live, at = live[going], at[going]
        if not len(live):
            return nodes, far
        done[live, at] = True
        near = neighbours[nodes[live, at]]
        valid = near >= 0
        safe = np.where(valid, near, 0)
        valid &= ~seen[live[:, None], safe]
        row, place = np.nonzero(valid)
        seen[live[row], near[row, place]] = True  # the valid ones alone: safe also names node 0
        distance = np.where(valid, _distances(vectors, safe, targets[live]), np.inf)
        all_nodes = np.concatenate((nodes[live], np.where(valid, near, -1)), axis=1)
        all_far = np.concatenate((far[live], distance), axis=1)
        all_done = np.concatenate((done[live], np.zeros_like(valid)), axis=1)
        best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        nodes[live] = np.take_along_axis(all_nodes, best, axis=1)
        far[live] = np.take_along_axis(all_far, best, axis=1)
        done[live] = np.take_along_axis(all_done, best, axis=1)


def robust_prune(
    vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """At most ``degree`` candidates of each point, diverse in direction; -1 where fewer.

    The nearest candidate is kept, and those that are alpha times as near to it
    as to the point go, until none is left. Candidates of -1 are none.
    """
    candidates = np.where(candidates == points[:, None], -1, candidates)
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    safe = np.maximum(candidates, 0)
    distance = np.where(candidates < 0, np.inf, _distances(vectors, safe, vectors[points]))
    out = np.full((len(points), degree), -1, dtype=np.int32)
    left = distance.copy()
    rows = np.arange(len(points))
    for k in range(degree):
        at = left.argmin(axis=1)
        some = np.isfinite(left[rows, at])
        if not some.any():
            break
        chosen = np.where(some, candidates[rows, at], -1)
        out[:, k] = chosen
        pick = np.maximum(chosen, 0)
        between = _distances(vectors, safe, vectors[pick])
        left[some[:, None] & (alpha * alpha * between <= distance)] = np.inf
        left[rows, at] = np.inf
    return out


def build_graph(vectors: np.ndarray, settings: Settings, block: int = 512, seed: int = 11) -> tuple[np.ndarray, int]:
    """Neighbours of every node, and the entry: the node nearest to the mean.

    From random neighbours, two passes (alpha 1, then the set one) search for
    every node and prune what its search met; edges are then given back, and
    nodes with too many are pruned again.
    """
    count = len(vectors)
    entry = int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())
    degree = min(settings.degree, max(count - 1, 1))
    random = np.random.default_rng(seed)
    neighbours = random.integers(0, count, (count, degree)).astype(np.int32)
    neighbours[neighbours == np.arange(count)[:, None]] = -1
    neighbours = _once(neighbours)
    for alpha in (1.0, settings.alpha):
        order = random.permutation(count)
        for at in range(0, count, block):
            points = order[at : at + block]
            met, _ = beam_search(vectors, neighbours, entry, vectors[points], min(settings.build_beam, count))
            neighbours[points] = robust_prune(
                vectors, points, np.concatenate((met, neighbours[points]), axis=1), degree, alpha
            )
            _give_back(vectors, neighbours, points, alpha)
    return _within_reach(neighbours, entry), entry


def _reached(neighbours: np.ndarray, entry: int) -> np.ndarray:
    found = np.zeros(len(neighbours), dtype=bool)
    front = np.array([entry])
    while len(front):
        found[front] = True
        front = np.unique(neighbours[front])
        front = front[front >= 0]
        front = front[~found[front]]
    return found


def _within_reach(neighbours: np.ndarray, entry: int, least: int = 3, ways: int = 4) -> np.ndarray:
    """The graph with further edges, so that every node can be met from the entry.

    Pruning may leave a node with hardly an edge towards it. Such nodes get one
    from each of their own ``ways`` nearest neighbours, and what is still out of
    reach from its nearest neighbour within reach, or from the entry.
    """
    count = len(neighbours)
    incoming = np.bincount(neighbours[neighbours >= 0], minlength=count)
    poor = np.flatnonzero(incoming < least)
    sources, targets = neighbours[poor, :ways].ravel(), np.repeat(poor, neighbours[poor, :ways].shape[1])
    neighbours = _with_edges(neighbours, sources[sources >= 0], targets[sources >= 0])
    while not (found := _reached(neighbours, entry)).all():
        lost = np.flatnonzero(~found)
        own = neighbours[lost]
        usable_ = (own >= 0) & found[np.maximum(own, 0)]
        first = own[np.arange(len(lost)), usable_.argmax(axis=1)]
        some = usable_.any(axis=1)
        if not some.any():
            first, some = np.full(1, entry), np.ones(1, dtype=bool)
            lost = lost[:1]
        neighbours = _with_edges(neighbours, first[some], lost[some])
    return neighbours


def _once(neighbours: np.ndarray) -> np.ndarray:
    """Rows that name a node once."""
    neighbours = -np.sort(-neighbours, axis=1)
    neighbours[:, 1:][neighbours[:, 1:] == neighbours[:, :-1]] = -1
    return neighbours


def _with_edges(neighbours: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """The graph with edges that it does not have yet; none leads from a node to itself."""
    fresh = (neighbours[sources] != targets[:, None]).all(axis=1) & (sources != targets)
    edges = np.unique(np.stack((sources[fresh], targets[fresh])), axis=1)
    sources, targets = edges
    if not len(sources):
        return neighbours
    order = np.argsort(sources, kind="stable")
    sources, targets = sources[order], targets[order]
    nodes, begun, sizes = np.unique(sources, return_index=True, return_counts=True)
    wide = np.full((len(neighbours), int(sizes.max())), -1, dtype=np.int32)
    wide[sources, np.arange(len(sources)) - np.repeat(begun, sizes)] = targets
    return np.concatenate((neighbours, wide), axis=1)


def _give_back(vectors: np.ndarray, neighbours: np.ndarray, points: np.ndarray, alpha: float) -> None:
    """For each edge of ``points`` the reverse edge, pruning where there is no room."""
    degree = neighbours.shape[1]
    edges = neighbours[points]
    targets, sources = edges.ravel(), np.repeat(points, degree)
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    nodes, begun, sizes = np.unique(targets, return_index=True, return_counts=True)
    wide = np.full((len(nodes), int(sizes.max(initial=0))), -1, dtype=np.int64)
    nth = np.arange(len(targets)) - np.repeat(begun, sizes)
    wide[np.repeat(np.arange(len(nodes)), sizes), nth] = sources
    known = (wide[:, :, None] == neighbours[nodes][:, None, :]).any(axis=2)
    wide[known] = -1
    free = (neighbours[nodes] < 0).sum(axis=1)
    wanted = (wide >= 0).sum(axis=1)
    fits = wanted <= free
    both = np.concatenate((neighbours[nodes], wide), axis=1)
    room = both[fits]
    room = np.take_along_axis(room, np.argsort(room < 0, axis=1, kind="stable"), axis=1)
    neighbours[nodes[fits]] = room[:, :degree]
    full = nodes[~fits]
    for at in range(0, len(full), 512):
        part = slice(at, at + 512)
        neighbours[full[part]] = robust_prune(vectors, full[part], both[~fits][part], degree, alpha)


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, vector, dims) of vectors that take part.

    Null, empty and zero vectors, and those with a null or non-finite component,
    do not. ``row`` tells rows apart: it is the vec_id where that is unique. Other
    columns are left behind.
    """
    doubles = F.col(vector).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = (
        rows.select(F.col(key).cast("long").alias("vec_id"), doubles.alias("vector"))
        .filter("size(vector) > 0")
        .filter(finite & F.exists("vector", lambda x: x != 0))
        .withColumn("dims", F.size("vector"))
    )
    known, name = row_keys(own, "vec_id")
    return known.select(F.col(name).alias("row"), "vec_id", "vector", "dims")


def build_index(rows: DataFrame, settings: Settings = Settings(), copies: int = 11) -> DataFrame:
    """The index of rows from ``usable``: one row per node, see INDEX.

    Vectors of each number of dimensions have shards of their own. All rows are
    indexed; a node lists the ``copies`` smallest ids of its equal vectors, null
    last, and their rows.
    """
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"))
    shards = F.ceil(F.col("n") / settings.shard_rows)
    dealt = rows.join(F.broadcast(sizes), "dims").select(
        F.pmod(F.xxhash64("row"), shards).alias("shard"), "dims", "row", "vec_id", "vector"
    )

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["vec_id", "row"], kind="stable", na_position="last")
        exact = np.stack(part["vector"].to_numpy())
        exact += 0.0  # one zero
        _, first, same = np.unique(exact, axis=0, return_index=True, return_inverse=True)
        order = np.argsort(first)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        same, first = place[same.ravel()], first[order]
        ids: list[list[int | None]] = [[] for _ in first]
        rows_: list[list[int]] = [[] for _ in first]
        known = part["vec_id"].astype("object").where(part["vec_id"].notna(), None).tolist()
        for node, vec_id, row in zip(same.tolist(), known, part["row"].tolist(), strict=True):
            if len(ids[node]) < copies:
                ids[node].append(None if vec_id is None else int(vec_id))
                rows_[node].append(row)
        vectors = exact[first]
        neighbours, entry = build_graph(_narrow(_scaled(vectors)), settings)
        return pd.DataFrame(
            {
                "shard": part["shard"].iloc[0],
                "dims": part["dims"].iloc[0],
                "node": np.arange(len(first)),
                "ids": ids,
                "rows": rows_,
                "entry": np.arange(len(first)) == entry,
                "vector": list(vectors),
                "neighbours": [own[own >= 0] for own in neighbours],
            }
        )

    return dealt.groupBy("dims", "shard").applyInPandas(build, INDEX)


def _scaled(vectors: np.ndarray, by: np.ndarray | None = None) -> np.ndarray:
    """Around a usual length of 1, so that squares neither overflow nor vanish."""
    return vectors / np.median(np.abs(vectors if by is None else by).max(axis=1))


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """In single precision, unless some vectors lie so far from the rest that their squares would overflow."""
    return vectors.astype(np.float32) if np.abs(vectors).max() < 1e15 else vectors


class _Shard:
    """One shard, held while the queries that are dealt to it stream past."""

    def __init__(self, rows: list[dict], settings: Settings, most: int) -> None:
        rows = sorted(rows, key=lambda row: row["node"])
        self.most, self.ids, self.rows = most, [r["ids"] for r in rows], [r["rows"] for r in rows]
        self.exact = np.array([r["vector"] for r in rows])
        # Null ids stand last among equals.
        self.order = np.array([float("inf") if own[0] is None else own[0] for own in self.ids])
        self.beam = max(settings.search_beam, most + 1)
        self.entry = next(k for k, r in enumerate(rows) if r["entry"])
        widest = max(1, *(len(r["neighbours"]) for r in rows))
        self.neighbours = np.full((len(rows), widest), -1, dtype=np.int32)
        for k, r in enumerate(rows):
            self.neighbours[k, : len(r["neighbours"])] = r["neighbours"]
        self.scaled = _scaled(self.exact)
        self.narrow = _narrow(self.scaled)

    def met(self, queries: np.ndarray) -> np.ndarray:
        """The nodes that each query meets, -1 for none; all of them where a beam holds them."""
        if len(self.exact) <= self.beam:
            return np.tile(np.arange(len(self.exact)), (len(queries), 1))
        wanted = _narrow(_scaled(queries, self.exact))
        held = self.narrow if wanted.dtype == np.float32 else self.scaled
        return beam_search(held, self.neighbours, self.entry, wanted, self.beam)[0]

    def found(self, queries: list[tuple[int, int | None, list[float]]]) -> Iterator[tuple]:
        """Rows of FOUND for some queries (row, id, vector)."""
        wanted = np.array([vector for *_, vector in queries])
        for (query_row, query_id, _), query, nodes in zip(queries, wanted, self.met(wanted), strict=True):
            nodes = nodes[nodes >= 0]
            with np.errstate(over="ignore"):
                scores = np.sqrt(((self.exact[nodes] - query) ** 2).sum(axis=1))
            own = [
                (query_row, query_id, row, vec_id, float(scores[k]))
                for k in np.lexsort((self.order[nodes], scores))[: self.most + 1].tolist()
                for vec_id, row in zip(self.ids[nodes[k]], self.rows[nodes[k]], strict=True)
                if row != query_row
            ]
            own.sort(key=lambda x: (x[4], x[3] is None, x[3] or 0, x[2]))
            yield from own[: self.most]


def search(index: DataFrame, queries: DataFrame, most: int = 10, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``most`` nearest found of each query.

    ``queries`` are rows from ``usable``. Every shard of a query's number of
    dimensions is searched; a query's own row is no result. The score is the
    Euclidean distance of the original vectors in double precision; ties go to
    the smaller vec_id, null being the largest. A task holds one shard, and the
    queries stream past it.
    """
    shards = index.select("dims", "shard").distinct()
    # Both sides of a shard as rows of one kind, nodes first.
    nodes = index.select("dims", "shard", F.lit(0).alias("kind"), "node", "ids", "rows", "entry", "vector", "neighbours")
    asked = queries.join(shards, "dims").select(
        "dims", "shard", F.lit(1).alias("kind"), F.lit(-1).alias("node"), F.array("vec_id").alias("ids"),
        F.array("row").alias("rows"), F.lit(False).alias("entry"), "vector", F.array().cast("array<int>").alias("neighbours"),
    )
    schema = batches(FOUND)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        for batch in stream:
            for at in range(0, batch.num_rows, 256):
                waiting: list[tuple] = []
                out: list[tuple] = []
                for row in batch.slice(at, 256).to_pylist():
                    if (row["dims"], row["shard"]) != key:
                        if waiting:
                            out.extend(shard.found(waiting))
                            waiting = []
                        key, held, shard = (row["dims"], row["shard"]), [], None
                    if not row["kind"]:
                        held.append(row)
                        continue
                    if shard is None:
                        shard, held = _Shard(held, settings, most), []
                    waiting.append((row["rows"][0], row["ids"][0], row["vector"]))
                if waiting:
                    out.extend(shard.found(waiting))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    dealt = nodes.unionByName(asked).repartition("dims", "shard").sortWithinPartitions("dims", "shard", "kind")
    met = dealt.mapInArrow(run, FOUND)
    order = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, every: int = 100, most: int = 10, settings: Settings = Settings()) -> DataFrame:
    """The nearest of every row whose vec_id is divisible by ``every``, among all other rows.

    An empty table gives an empty result; a query with fewer candidates gets
    them all. Rows that share a vec_id are queries and candidates of their own,
    as are, among the candidates, rows without one; their vec_id is null.
    """
    own = written(usable(rows), "vectors")
    index = written(build_index(own, settings, most + 1), "graph")
    return search(index, own.filter(F.col("vec_id") % every == 0), most, settings)
