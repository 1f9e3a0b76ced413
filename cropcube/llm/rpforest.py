"""Embedding near-duplicates with a forest of random-projection trees.

Trees are fitted on a bounded sample: each node splits at the median of a random
projection, and points close to the median go to both sides (spill).  Vectors are
sent down every tree and compared within leaves, pairs are verified by cosine, and
links are united to components.

A split would cut through a dense group, so dense places of the sample get leaves of
their own first: a leader, and all vectors within twice the threshold's angle of it.
By the triangle inequality that leaf holds every link of a vector within the angle
itself (the leader's core), so core vectors need no tree, and trees are fitted on the
others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.common import written
from cropcube.llm.components import components, local_components
from cropcube.llm.vectors import list_matrix, matrix, unit, usable

TREES = 10
#: Share of a node's points on either side of the median that go to both children.
SPILL = 0.06
#: Vectors that the trees are fitted on; every vector is indexed.
SAMPLE = 20_000
LEAF = 128
#: Rows of a leaf that one task compares with as many; larger leaves are cut into such blocks.
BLOCK = 2048


class Tree:
    """Nodes in arrays: direction, interval that goes both ways, children; leaves numbered from ``first``."""

    def __init__(self, sample: np.ndarray, seed: int, first: int):
        self.rng = np.random.default_rng(seed)
        self.direction, self.low, self.high, self.children = [], [], [], []
        self.leaves, self.first = 0, first
        self.root = self._grow(sample)
        self.direction = np.array(self.direction).reshape(-1, sample.shape[1])
        del self.rng

    def _grow(self, x: np.ndarray) -> int:
        """Node number, or minus leaf number minus one."""
        if len(x) > LEAF:
            for _ in range(8):
                d = self.rng.standard_normal(x.shape[1])
                p = x @ (d / np.linalg.norm(d))
                low, high = np.quantile(p, [0.5 - SPILL, 0.5 + SPILL])
                left, right = p <= high, p >= low
                if left.sum() < 0.9 * len(x) and right.sum() < 0.9 * len(x):
                    at = len(self.low)
                    self.direction.append(d / np.linalg.norm(d))
                    self.low.append(low)
                    self.high.append(high)
                    self.children.append(None)
                    self.children[at] = (self._grow(x[left]), self._grow(x[right]))
                    return at
        self.leaves += 1
        return -self.leaves

    def leaves_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves that the rows reach."""
        rows, leaves = [], []
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, who = todo.pop()
            if not len(who):
                continue
            if node < 0:
                rows.append(who)
                leaves.append(np.full(len(who), self.first - node - 1))
                continue
            p = x[who] @ self.direction[node]
            todo.append((self.children[node][0], who[p <= self.high[node]]))
            todo.append((self.children[node][1], who[p >= self.low[node]]))
        return np.concatenate(rows), np.concatenate(leaves)


def plant(sample: np.ndarray, trees: int = TREES, seed: int = 7, first: int = 0) -> list[Tree]:
    out = []
    for t in range(trees):
        out.append(Tree(sample, seed * 1000 + t, first))
        first += out[-1].leaves
    return out


def leaders(sample: np.ndarray, threshold: float) -> np.ndarray:
    """Members of the sample whose cores cover all that have over half a leaf of it within the threshold."""
    x = sample.astype(np.float32)
    count = [(x[at:at + 512] @ x.T >= threshold).sum(axis=1) for at in range(0, len(x), 512)]
    count = np.concatenate([*count, np.zeros(0, np.int64)])
    todo, found = count > LEAF // 2, []
    while todo.any():
        found.append(int(np.where(todo, count, 0).argmax()))
        todo &= sample @ sample[found[-1]] < threshold
        todo[found[-1]] = False
    return sample[found]


class Forest:
    """Leaves of the leaders, numbered from 0, and trees over what is in no core."""

    def __init__(self, sample: np.ndarray, threshold: float):
        self.threshold = threshold
        self.reach = 2 * threshold ** 2 - 1 - 1e-9 if threshold > 0 else -2.0  # cosine of twice the angle
        self.leaders = leaders(sample, threshold)
        free = np.ones(len(sample), bool) if not len(self.leaders) else \
            np.concatenate([(sample[at:at + 1024] @ self.leaders.T).max(axis=1) < threshold
                            for at in range(0, len(sample), 1024)])
        self.trees = plant(sample[free], first=len(self.leaders))

    def leaves_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves that the rows reach."""
        found, free = [], np.ones(len(x), bool)
        for at in range(0, len(x) if len(self.leaders) else 0, 1024):
            near = x[at:at + 1024] @ self.leaders.T
            row, leaf = np.nonzero(near >= self.reach)
            found.append((at + row, leaf))
            free[at:at + 1024] = near.max(axis=1) < self.threshold
        who = np.flatnonzero(free)
        found += [(who[row], leaf) for row, leaf in (t.leaves_of(x[who]) for t in self.trees if len(who))]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _first_common(leaf: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``leaf`` is the first leaf that the rows of a and b share; rows are padded with -1 and -2."""
    share = (a[:, :, None] == b[:, None, :]).any(axis=2)
    return np.where(share, a, np.iinfo(np.int32).max).min(axis=1) == leaf


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, label: str = "label",
                    vector: str = "embedding") -> DataFrame:
    """vec_id, n_links and component_id (smallest vec_id reachable) of every vector.

    Links join vectors of equal, non-null label and equal length with a cosine of at
    least ``threshold`` that meet in a leaf; pairs of equal vectors always do, and so does
    every pair with a member in a leader's core (groups of many slightly different copies,
    see above).  A null or
    zero vector, or one with a null or non-finite component, links with nothing.  Rows
    without vec_id are left out; rows that repeat a vec_id and its vector count once in
    others' links.  Equal vectors are compared once: the leaf stage holds each distinct
    one with its number of copies, so groups of copies of any size cost one row.  A pair
    counts in the first leaf that both share, and a leaf emits one row for each vector
    (its links and the smallest it connects to), never its pairs.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"  # floats travel as floats
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast(kind).alias("v")).where("vec_id is not null")
    good = usable("v") & F.col("label").isNotNull() & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    distinct = rows.where("good").groupBy("label", "v") \
        .agg(F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("copies"))
    distinct = written(distinct.select("id", "copies", F.col("label").cast("string").alias("l"), "v"),
                       "distinct-vectors")
    dims = [r.d for r in distinct.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(64)
            .collect()]
    forests = {}
    for d in dims:  # 64 lengths at most have trees, all others form a leaf of their own
        got = distinct.where(F.size("v") == d).orderBy(F.xxhash64("id"), "id").limit(SAMPLE // len(dims)) \
            .select("v").toArrow().column("v").combine_chunks()
        x = list_matrix(got, d)
        forests[d] = Forest(unit(x), threshold)
    sent = spark.sparkContext.broadcast(forests)

    def route(batches):
        for batch in batches:
            length = np.array([len(v) for v in batch.column("v").to_pylist()])
            for d in np.unique(length).tolist():
                part = batch.filter(pa.array(length == d))
                x = unit(list_matrix(part.column("v"), d))
                forest = sent.value.get(d)
                row, leaf = forest.leaves_of(x) if forest else (np.arange(len(x)), np.zeros(len(x), int))
                leaf = leaf[np.argsort(row, kind="stable")]
                off = np.append(0, np.cumsum(np.bincount(row, minlength=len(x))))
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(leaf, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("copies"), part.column("l"), part.column("v"),
                     pa.array(np.full(len(x), d), pa.int32()), lists], ["id", "copies", "l", "v", "d", "leaves"])

    routed = written(distinct.mapInArrow(
        route, f"id long, copies long, l string, v {kind}, d int, leaves array<int>"), "routed-vectors")
    met = routed.withColumn("leaf", F.explode("leaves"))
    large = met.groupBy("d", "leaf").count().where(F.col("count") > BLOCK) \
        .select("d", "leaf", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    met = met.join(large, ["d", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    met = met.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("b1", F.least("own", "other")).withColumn("b2", F.greatest("own", "other"))

    def compare(key, rows):
        dims, leaf, b1, b2 = map(int, key)
        x = unit(matrix(rows["v"], dims))
        ids, copies = rows["id"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
        labels = pd.factorize(rows["l"])[0]
        own = rows["own"].to_numpy()
        lists = [np.asarray(v, np.int64) for v in rows["leaves"]]
        width = max(map(len, lists))
        leaves = np.array([np.pad(v, (0, width - len(v)), constant_values=-1) for v in lists])
        left, right = np.flatnonzero(own == b1), np.flatnonzero(own == b2)
        links, pairs = np.zeros(len(ids), np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for at in range(0, len(left), 256):
            some = left[at:at + 256]
            close = (x[some] @ x[right].T >= threshold) & (labels[some][:, None] == labels[right][None, :])
            i, j = np.nonzero(close)
            i, j = some[i], right[j]
            if b1 == b2:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 8192):
                a, b = i[k:k + 8192], j[k:k + 8192]
                mine = _first_common(leaf, leaves[a], np.where(leaves[b] < 0, -2, leaves[b]))
                np.add.at(links, a[mine], copies[b[mine]])
                np.add.at(links, b[mine], copies[a[mine]])
            nodes, low = local_components(np.append(pairs[0], ids[i]), np.append(pairs[1], ids[j]))
            pairs = (nodes, low)
        count = dict(zip(ids.tolist(), links.tolist(), strict=True))
        return pd.DataFrame({"a": pairs[0], "b": pairs[1], "links": [count[n] for n in pairs[0].tolist()]}) \
            .astype("int64")

    found = written(met.select("d", "leaf", "b1", "b2", "id", "copies", "l", "v", "leaves", "own")
                    .groupBy("d", "leaf", "b1", "b2").applyInPandas(compare, "a long, b long, links long"), "leaf-links")
    links = found.groupBy("a").agg(F.sum("links").alias("others"))
    named = components(found.select("a", "b"))
    group = distinct.join(links, F.col("id") == F.col("a"), "left").drop("a") \
        .join(named, F.col("id") == F.col("node"), "left") \
        .select("l", "v", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component_id"))
    linked = rows.where("good").withColumn("l", F.col("label").cast("string")).join(group, ["l", "v"]) \
        .select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)
