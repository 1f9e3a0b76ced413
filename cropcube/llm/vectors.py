"""Blocks of vectors as rows: ids and a matrix in one binary each."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(good, F.lit(False))


def matrix(column: pd.Series, dims: int) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    return np.array([np.asarray(v, np.float64) for v in column], np.float64).reshape(len(column), dims)


def list_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column, all of whose rows have ``dims`` components, as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to norm 1, whatever their magnitude; none may be zero.

    Each is first scaled by a power of two, which is exact, so that its largest component is
    near 1 and neither squares nor sums leave the range of doubles.
    """
    if not x.size:
        return x
    _, power = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    x = np.ldexp(x, -power)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def in_blocks(vectors: DataFrame, block: int, key: str = "vec_id") -> DataFrame:
    """dims, n (block number among those of equal dims), ids and m (doubles, one dimension
    after another) for blocks of about ``block`` vectors.

    ``vectors`` has ``key`` and ``v`` (array of doubles).  Rows that repeat both count once.
    """
    sized = vectors.select(F.col(key).cast("long").alias("id"), "v", F.size("v").alias("dims"))
    count = sized.groupBy("dims").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = sized.join(count, "dims").withColumn("n", F.pmod(F.xxhash64("id"), F.col("blocks")))

    def pack(key, rows):
        m = matrix(rows["v"], int(key[0]))
        ids = rows["id"].to_numpy(np.int64)
        order = np.argsort(ids, kind="stable")
        ids, m = ids[order], m[order]
        if len(np.unique(ids)) < len(ids):
            _, first = np.unique(np.column_stack([ids, m.view(np.int64)]), axis=0, return_index=True)
            first.sort()
            ids, m = ids[first], m[first]
        return pd.DataFrame({"dims": [key[0]], "n": [key[1]], "ids": [ids.tobytes()],
                             "m": [np.ascontiguousarray(m.T).tobytes()]})

    return dealt.select("dims", "n", "id", "v").groupBy("dims", "n") \
        .applyInPandas(pack, "dims int, n long, ids binary, m binary")
