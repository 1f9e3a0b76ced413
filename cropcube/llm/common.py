"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders written by this application, for :func:`clean_scratch`.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a written table under ``spark.checkpoint.dir``.

    The folder is the shared one that the cluster names.  Where it is unset, only a
    session in local mode (tests) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = base or _own_checkpoint_dir()
    _SCRATCH.append(f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


#: Names of bucketed tables of this application, for :func:`clean_scratch`.
_TABLES: list[str] = []


def scratch_table(name: str) -> str:
    """A new name for a bucketed table, whose files go to a :func:`scratch_path`."""
    _TABLES.append(f"llm_{name}_{uuid.uuid4().hex}")
    return _TABLES[-1]


def clean_scratch(spark: SparkSession) -> None:
    """Delete all tables that :func:`scratch_path` and :func:`scratch_table` named so far, and no others.

    Results of this package read them, so call this once results have been saved.
    """
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _SCRATCH:
        _delete(spark, _SCRATCH.pop())


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@functools.cache
def _own_checkpoint_dir() -> str:
    import tempfile
    return "file://" + tempfile.mkdtemp(prefix="cropcube-llm-")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and a
    lost executor costs a reread of the table, not its upstream jobs."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table from :func:`written` that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def parts(spark: SparkSession) -> int:
    """Shuffle partitions of the session, for explicit repartitioning by key."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated bytes and int64 offsets of a string or binary column (null: empty)."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]  # the buffer may hold other rows too


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the bytes of ``column`` in one slice stay near ``limit``.

    A row longer than the limit forms a slice of its own; rows are never cut here.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(column).cast(pa.large_binary())
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... start+length-1 of each run, concatenated."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - before, lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E6C63D0876A9A35 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the rolling-hash base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Rolling-hash prefix sums of ``values``: span hashes come from :func:`span_hash`."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each span, the same wherever the span stands."""
    inverse = powers(len(sums))[1]
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix64(h + (ends - starts).astype(np.uint64))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_doc_id(df: DataFrame, *more) -> DataFrame:
    """Rows of a document table that have an identity, narrowed to doc_id, text and ``more``."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more) \
        .where(F.col("doc_id").isNotNull())
