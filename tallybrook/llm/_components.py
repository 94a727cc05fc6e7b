"""Connected components of an edge table, and a union-find for what one task holds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import join_counted, stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id on an edge (a, b); component is the smallest id reachable. Edges with a null end count for nothing.

    Large-star and small-star rounds: each node's larger, then smaller, neighbours are linked to its smallest one, until
    the edges are stars, which takes a number of rounds that grows with the logarithm of the nodes. Each round is a grouped
    minimum, combined before the shuffle, and a join in which nodes of many edges stay in place; it is written to the
    shared folder. The driver sees two numbers a round.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, now = None, _told(edges)
    while now != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = join_counted(both.where("b > a"), low, "a", "n", 2 * now[0])
        large = stored(large.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = join_counted(large, low, "a", "n", now[0])
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m")).where("a <> b").distinct()
        edges = stored(small, "edges")
        now = _told(edges)
    out = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return out.union(edges.select("b", "b").distinct())


def named(classes: DataFrame, total: int) -> DataFrame:
    """classes (id, component, name and more, `total` rows) with `least`, the smallest name of their component."""
    least = classes.groupBy("component").agg(F.min("name").alias("least"), F.count("*").alias("_rows"))
    return join_counted(classes, least, "component", "_rows", total).drop("_rows")


def _told(edges: DataFrame) -> tuple:
    """How many edges there are, and a sum of their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place of each place's component, of n places with links a-b."""
    root = np.arange(n)
    while len(a):
        low = root.copy()
        np.minimum.at(low, root[a], root[b])
        np.minimum.at(low, root[b], root[a])
        while (low[low] != low).any():
            low = low[low]
        root = low[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
