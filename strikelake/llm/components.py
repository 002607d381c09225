"""Connected components of a graph given by its edges, by alternating large-star and small-star steps.

Each step links every node to the smallest node it knows; the number of rounds grows with the logarithm of the longest
path. Minima are reduced where they are read. They come back to the edges by ``keyed_join``: a node with very many edges
is one of few, which are broadcast, so its edges stay where they are. Every round is stored in the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from strikelake.sources.storage import as_table


#: Keys that ``keyed_join`` broadcasts, at most, and rows that a key may have before it is one of them.
HOT_KEYS, COLD_ROWS = 50_000, 64


def keyed_join(rows: DataFrame, n_rows: int, table: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key and, in ``count``, how many of rows have it.

    Keys of more than ``n_rows`` / ``HOT_KEYS`` rows (n_rows: all rows there are) are less than HOT_KEYS: those are
    broadcast and their rows are not shuffled. Of the other keys none is a task of its own. ``how``: inner or left.
    """
    most = max(COLD_ROWS, n_rows // HOT_KEYS)
    hot, cold = F.broadcast(table.filter(F.col(count) > most)), table.filter(F.col(count) <= most)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how))


def _stars(edges: DataFrame, large: bool, n_edges: int) -> DataFrame:
    """(a, b), b < a: every neighbour b of a node linked to the node's smallest neighbour (or itself).

    large: only neighbours above the node move; else only those below, and the node itself.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = as_table(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree")).select(
        "a", F.least("a", "m").alias("m"), "degree"), "component-least")
    moved = keyed_join(both, 2 * n_edges, least, ["a"], "degree")
    if large:
        out = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") > F.col("b"))


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and then none to it: the graph is a set of stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    counted = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return counted.filter((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of all nodes that have an edge; component is the smallest node reachable.

    edges has integer columns a and b; nulls, loops, repeats and either direction are fine. No edges: no rows.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = as_table(edges, name)
    while not _settled(edges):
        for large in (True, False):
            edges = as_table(_stars(edges, large, edges.count()).distinct(), name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def forest(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest, as edges between ids, of the links of a block pair (rows x columns)."""
    i, j = np.nonzero(linked)
    if not len(i):
        return []
    ids, ends = np.unique(np.r_[rows[i], columns[j]], return_inverse=True)
    a, b = ends[: len(i)], ends[len(i) :]
    least = np.arange(len(ids))
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, least[a], low)
        np.minimum.at(new, least[b], low)
        new = new[new]
        if (new == least).all():
            break
        least = new
    return [(int(ids[x]), int(ids[y])) for x, y in enumerate(least.tolist()) if x != y]
