"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import shared_table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v), both bigint.

    ``component`` is the smallest node that can be reached. Loops, repeated
    edges and both directions of an edge are fine; an empty edge list gives no
    rows. Every round is two aggregates and two joins, written to the shared
    folder; the driver sees one count and one checksum of a round. Long chains
    end after about log n rounds. A node with very many edges only meets its
    minimum, which is aggregated before the shuffle; its edges are split by
    the adaptive skew join.
    """
    e = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = shared_table(e.distinct(), "edges")
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = shared_table(small.unionAll(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))


def local_roots(a: np.ndarray, b: np.ndarray, node: np.ndarray) -> np.ndarray:
    """For positions linked in pairs (a, b): the smallest node of each
    position's component, by label rounds inside one task."""
    root = node.copy()
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == root).all():
            return root
        root = new


def local_star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that connect what the pairs (a, b) connect, one for each
    position but the smallest of its component."""
    at, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = local_roots(number[:len(a)], number[len(a):], at)
    return at[root != at], root[root != at]
