"""Connected components of links, distributed: alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.common import drop_written, written


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links a-b, and the smallest node that each reaches through them."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while len(u):
        x, y = label[u], label[v]
        apart = x != y
        if not apart.any():
            break
        x, y, u, v = x[apart], y[apart], u[apart], v[apart]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]
    return nodes, nodes[label]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link for each node that joins the same components: node to smallest node."""
    nodes, low = local_components(a, b)
    keep = nodes != low
    return nodes[keep], low[keep]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(low.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of the links.

    ``edges`` has long columns ``a`` and ``b``; null ends and self-links are ignored,
    repeated links are fine, and no links give an empty result.  Each round is written
    to the shared folder, so lineage stays short.  Converges in about log2 of the
    longest chain of links; every round costs two aggregations and two equi-joins.
    """
    now = written(_small_star(edges.select("a", "b").where("a != b")), "links")
    state = None
    while True:
        nxt = written(_small_star(_large_star(now)), "links")
        new = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        drop_written(now)
        now = nxt
        if new == state or not new[0]:
            break
        state = new
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
