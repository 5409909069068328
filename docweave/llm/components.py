"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Each step keeps the number of edges, takes minima by partial aggregation and
    joins them back, where adaptive execution can split a hub's partition.  The
    number of steps grows with the logarithm of the longest path.  Self links and
    repeated links are allowed, links with a null end are ignored.  No edges give
    an empty table.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"`{a}` is not null and `{b}` is not null")
    nodes = materialise(e.distinct())
    e, seen = nodes.where("u <> v"), None
    while True:
        e = materialise(_small_star(_large_star(e)))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    alone = nodes.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return out.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))


def _large_star(e: DataFrame) -> DataFrame:
    """Link every neighbour that is larger than u with the smallest of u and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours with the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


class Forest:
    """Components of the rows of one task; keeps one label a row, however many links come."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.label[i], self.label[j]
        keep = a != b
        if not keep.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b)[keep], np.maximum(a, b)[keep]], 1), axis=0)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := parent.get(x, x)) != x:
                parent[x] = x = parent.get(y, y)
            return x

        for x, y in pairs.tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        to = np.arange(len(self.label))
        for x in parent:
            to[x] = root(x)
        self.label = to[self.label]

    def edges(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, id of its root) for every row that isn't its own root."""
        rows = np.flatnonzero(self.label != np.arange(len(self.label)))
        return ids[rows], ids[self.label[rows]]
