"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm.common import discard, staged

MAX_ROUNDS = 60


def trees(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node of its component) with the components of the edges (u, v)."""
    names, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while True:  # halve the paths
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        if np.array_equal(before, root):
            break
    own = np.flatnonzero(root != np.arange(len(names)))
    return names[own], names[root[own]]


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``; root is the least node reachable.

    Each round is two aggregations to a minimum (combined before the shuffle) and two joins.
    Edges are held in a staged table after each round. Ends when a round changes nothing.
    """
    current = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(current)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        # minima are written before they are joined: a join of two tables can split a hot node, one of an aggregate cannot
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
        large = staged(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        down = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, current = current, staged(low.select("u", F.col("m").alias("v")).unionByName(down).distinct(), "cc")
        discard(before, least, large, low)
        now = mark(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
