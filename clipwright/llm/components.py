"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.shared import discard, materialize


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """In place: labels[x] is the smallest index known to be connected with x; adds the edges (i, j)."""
    while True:
        a, b = labels[i], labels[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low != high
        if not apart.any():
            return
        np.minimum.at(labels, high[apart], low[apart])
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).head())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (a, b: long, any order, repeats and loops allowed) to (node, component): the smallest node reachable.

    Nodes without an edge to another node are absent. Each round is two aggregations to a minimum and two joins; no
    neighbourhood is ever gathered. The minima are written before they are joined: a join of two stored tables is one
    whose large partitions, such as a hub's, Spark splits. Raises if not done in `max_rounds`, which the logarithmic
    number of rounds keeps out of reach.
    """
    canonical = lambda x, y: edges.where(F.col("a") != F.col("b")).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    now = materialize(canonical("a", "b").distinct(), "edges")
    seen = _signature(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")), "lowest")
        stars = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(stars.unionByName(low.where("m < a").select("a", F.col("m").alias("b"))).distinct(), "stars")
        lower = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = materialize(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), "edges")
        discard(now, low, large, lower)
        now, was, seen = after, seen, _signature(after)
        if was == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
