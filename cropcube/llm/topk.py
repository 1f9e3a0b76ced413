"""Exact top-k inner-product search by columnar branch and bound."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropcube.llm.common import parts, written
from cropcube.llm.vectors import in_blocks

CANDIDATES = 4096
QUERIES = 1024
DIMENSIONS = 8


def best(q: np.ndarray, m: np.ndarray, rest: np.ndarray, own: np.ndarray, k: int, step: int = DIMENSIONS,
         floor: float = -np.inf):
    """Columns of ``m`` (dimensions x candidates) with the k largest inner products, ties included.

    ``rest[b]`` holds each candidate's norm over the dimensions from block b on.  After
    each block, what the remaining dimensions can add or take is at most the product of
    both remaining norms; a candidate whose upper bound is under the k-th best lower
    bound is dropped, and the rest are compacted.  ``own`` marks candidates left out.  ``floor``
    is a score that k candidates are known to reach, here or elsewhere: under it none counts.
    """
    live = np.flatnonzero(~own)
    total = np.zeros(len(live))
    q_rest = np.sqrt(np.append(np.cumsum((q ** 2)[::-1])[::-1], 0.0))
    for b, at in enumerate(range(0, len(q), step)):
        total = total + q[at:at + step] @ m[at:at + step, live]
        if len(live) > k or floor > -np.inf:
            slack = q_rest[min(at + step, len(q))] * rest[b + 1][live] * (1 + 1e-9)
            low = max(floor, np.partition(total - slack, len(live) - k)[len(live) - k]) if len(live) > k else floor
            keep = total + slack >= low
            if not keep.all():
                live, total = live[keep], total[keep]
    return live, total


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best candidates.

    Both inputs have ``vec_id`` and ``v`` (array of whole numbers as doubles); a query's
    own vec_id is no candidate, vectors of another length are none either.  Score: inner
    product, exact while sums stay below 2**53.  Ties go to the smaller vec_id.  Queries
    without a candidate, and empty tables, give no rows.  Blocks of queries meet blocks of
    candidates through an equi-join on the number of the one and a salt of the other, so pairs
    spread over all tasks, and a task holds one pair at a time.  A first pass over one block of
    candidates gives every query a score to start from.
    """
    spark = candidates.sparkSession
    tasks = parts(spark)
    asked = written(in_blocks(queries, QUERIES), "query-blocks")
    among = written(in_blocks(candidates, CANDIDATES).select("dims", F.col("n").alias("c_n"), F.col("ids").alias("c_ids"),
                                                             F.col("m").alias("c_m")), "candidate-blocks")

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("dims", "ids", "m", "floors", "c_ids", "c_m")}
                ids, c_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["c_ids"], np.int64)
                floors = np.frombuffer(row["floors"]) if row["floors"] else np.full(len(ids), -np.inf)
                q = np.frombuffer(row["m"]).reshape(row["dims"], len(ids))
                m = np.frombuffer(row["c_m"]).reshape(row["dims"], len(c_ids))
                square = np.vstack([np.cumsum((m ** 2)[::-1], axis=0)[::-1], np.zeros((1, len(c_ids)))])
                edges = [*range(0, row["dims"], DIMENSIONS), row["dims"]]
                rest = np.sqrt(square[edges])
                out = []
                for j, query in enumerate(ids.tolist()):
                    live, total = best(np.ascontiguousarray(q[:, j]), m, rest, c_ids == query, k, floor=floors[j])
                    order = np.lexsort((c_ids[live], -total))[:k]
                    out.append((np.full(len(order), query), c_ids[live[order]], total[order].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([o[x] for o in out])) for x in range(3)], ["query_id", "vec_id", "score"])

    def first(batches):
        """Each query block with the k-th score of each of its queries in the first block of candidates."""
        for batch in batches:
            floors = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("dims", "ids", "m", "c_ids", "c_m")}
                ids, c_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["c_ids"] or b"", np.int64)
                score = np.full((len(ids), max(len(c_ids), k)), -np.inf)
                if len(c_ids):
                    q, m = (np.frombuffer(row[x]).reshape(row["dims"], n) for x, n in (("m", len(ids)), ("c_m", len(c_ids))))
                    score[:, :len(c_ids)] = np.where(ids[:, None] == c_ids[None], -np.inf, q.T @ m)
                floors.append(np.partition(score, -k, axis=1)[:, -k].tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("dims", "n", "ids", "m")], pa.array(floors, pa.binary())],
                                             ["dims", "n", "ids", "m", "floors"])

    opening = asked.join(among.where("c_n = 0").drop("c_n"), "dims", "left")
    asked = written(opening.mapInArrow(first, "dims int, n long, ids binary, m binary, floors binary"), "query-floors")
    # pairs of blocks are dealt out one by one: work goes by pairs, so a few small rows must not share a task
    count = asked.groupBy("dims").agg((F.max("n")).alias("last"))
    pairs = among.join(count, "dims").withColumn("n", F.explode(F.sequence(F.lit(0).cast("long"), "last"))) \
        .withColumn("salt", F.pmod(F.xxhash64("c_n"), F.lit(tasks)))
    salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long"))))
    met = pairs.repartition(tasks, "dims", "n", "salt").join(salted.repartition(tasks, "dims", "n", "salt"), ["dims", "n", "salt"])
    found = met.select("dims", "ids", "m", "floors", "c_ids", "c_m").mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
