"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes under the links ``i[k] - j[k]``."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            break
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def _canonical(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u > v")
        .distinct()
    )


def _is_star_forest(edges: DataFrame) -> bool:
    many = edges.groupBy("u").count().filter("count > 1")
    if not many.isEmpty():
        return False
    roots = edges.select(F.col("v").alias("u")).distinct()
    return edges.join(roots, "u", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` that is not a root itself.

    ``root`` is the smallest node reachable. Each round hangs the larger
    neighbours of a node on the smallest one, then the smaller ones, as two
    aggregations with map-side minima and two joins; no node's neighbours are
    ever gathered in one place, so a hub is as good as any other node. The
    number of rounds grows with the logarithm of the longest chain. Null ends
    and self-loops are dropped; an empty table gives an empty one.
    """
    edges = cut(_canonical(edges.select("u", "v").dropna()), "edges")
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = _canonical(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = cut(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = cut(
            _canonical(
                small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                    least.select("u", F.col("m").alias("v"))
                )
            ),
            "edges",
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
