"""Connected components by distributed union-find.

Edges are first contracted to a spanning forest within every partition, then
joined to trees by alternating large-star and small-star steps, each of which
is one shuffle of the edges. No step keeps the neighbours of a node together:
the smallest neighbour is a combinable aggregate, so a hub may have any number
of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import written

ROUNDS = 60


class Forest:
    """Union-find over arbitrary hashable items; the smallest item is the root."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, item):
        parent = self.parent
        root = item
        while (above := parent.get(root, root)) != root:
            root = above
        while item != root:
            above = parent.get(item, item)
            parent[item] = root
            item = above
        return root

    def union(self, one, other) -> bool:
        one, other = self.find(one), self.find(other)
        if one == other:
            return False
        low, high = (one, other) if one < other else (other, one)
        self.parent.setdefault(low, low)
        self.parent[high] = low
        return True


def _contract(limit: int):
    """Edges of a partition to links from each node to its smallest in the partition.

    Memory is bounded: the forest is written out whenever it holds ``limit`` nodes.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def links() -> pa.RecordBatch:
            pairs = [(node, forest.find(node)) for node in list(forest.parent)]
            pairs = [pair for pair in pairs if pair[0] != pair[1]]
            a = np.array([p[0] for p in pairs], dtype=np.int64)
            b = np.array([p[1] for p in pairs], dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in stream:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                forest.union(a, b)
            if len(forest.parent) >= limit:
                yield links()
                forest = Forest()
        if forest.parent:
            yield links()

    return run


def _smallest(edges: DataFrame) -> DataFrame:
    """Each node of edges (a, b) with the smallest node next to it, itself included."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    return low.select(F.col("a").alias("node"), F.least("a", "low").alias("low"))


def components(edges: DataFrame, rounds: int = ROUNDS, limit: int = 1_000_000) -> DataFrame:
    """(node, component) for every node on an edge (a, b) of two longs.

    The component is the smallest node reachable. Null ends and loops are no
    edges; repeated edges count once. Raises if ``rounds`` do not settle, which
    the number of rounds being logarithmic makes impossible below 2^30 hops.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    current = written(edges.mapInArrow(_contract(limit), "a long, b long"), "forest")
    if current.count() <= limit:  # a forest of bounded size settles in one pass
        current = written(current.coalesce(1).mapInArrow(_contract(2 * limit + 1), "a long, b long"), "stars")
        return _labelled(current)
    for _ in range(rounds):
        following = written(_small_star(_large_star(current)), "stars")
        settled = following.exceptAll(current).isEmpty() and current.exceptAll(following).isEmpty()
        current = following
        if settled:
            return _labelled(current)
    raise RuntimeError("components did not settle")


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node move to the smallest node next to it."""
    low = _smallest(edges)
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        both.filter("b > a")
        .join(low, F.col("a") == F.col("node"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .filter("a <> b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """What lies below a node, and the node itself, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    moved = F.array(
        F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
    )
    joined = down.join(least, F.col("a") == F.col("node"))
    return joined.select(F.inline(moved)).filter("a <> b").distinct()


def _labelled(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
