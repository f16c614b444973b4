"""Connected components of a large graph, by alternating star contractions.

Every turn links each node's larger neighbours to its smallest one (large
star), then its smaller neighbours (small star), until the edges are stars
around the smallest node of each component. Minima are aggregated before they
are joined back, so no node's neighbours are collected; each turn is stored in
the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shoplens.llm.common import save


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _stored(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The stored edges, and their number and combined hash, observed as they are written."""
    seen = Observation()
    stored = save(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("h")), name)
    return stored, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, name: str = "components", turns: int | None = None) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the component's smallest node.

    Loops, repeated and reversed edges may occur; nodes without an edge to
    another node are not returned; rows with a null are left out. With
    ``turns`` given it stops after so many: nodes with one root are then
    connected, but a component may still have several roots.
    """
    kept = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, seen = _stored(kept, f"{name}-0")
    turn, last = 0, None
    while turn != turns:
        turn += 1
        last = seen
        now, seen = _stored(_small_star(_large_star(now)), f"{name}-{turn}")
        if seen == last:
            break
    if turns is not None and seen != last:  # not yet stars: a node may have several edges, and be another's root
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), "v"))
        return both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Root (smallest index) of each of ``n`` nodes under the edges (a[i], b[i])."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root
