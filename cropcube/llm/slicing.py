"""Documents dealt into slices, and hashes that slices compare through buckets.

A slice is some rows of the table, dealt by the hash of their number, so neither one
doc_id on many rows nor long texts come together; the bytes of all texts and the number of
rows give the number of slices.  The slices are written once as a bucketed table, so later passes read each slice whole without a
shuffle of texts; only what passes want to know about hashes is shuffled.  A slice
names each hash once, however often it holds it, so a passage that a third of all
documents share costs one entry for each slice.

Rows that share a doc_id may lie in several slices.  Their order is that of the slices'
numbers, then of their texts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.common import as_bytes, parts, scratch_path, scratch_table, with_doc_id

#: Rows and bytes of texts in a slice, about; a longer text is a slice with what else falls there.
SLICE_DOCS, SLICE_BYTES = 500, 4 << 20
#: Bytes of texts whose hashes fall into one bucket, about, and the most buckets a stored table may have.
BUCKET_BYTES, TABLE_BUCKETS = 32 << 20, 100_000

NAMED = "bucket int, slice long, hashes binary, twice binary, doc binary, pos binary"


class Slices:
    """The bucketed table of (slice, doc_id, text, carried columns), in the shared scratch folder.

    Carried columns are named carry_0, carry_1, ... so that they clash with nothing.  ``buckets``
    for hashes grow with the texts, so that a bucket does not.  ``docs`` should be a stored
    table: rows are numbered where they are read.
    """

    def __init__(self, docs: DataFrame, docs_per_slice: int = SLICE_DOCS, carry: Sequence[str] = (), bytes_per_slice: int = SLICE_BYTES):
        self.spark = docs.sparkSession
        self.name = scratch_table("slices")
        docs = with_doc_id(docs, *[F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)])
        rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        number = max(1, -(-rows // docs_per_slice), -(-size // bytes_per_slice))
        self.buckets = max(parts(self.spark), -(-size // BUCKET_BYTES))
        stored = min(self.buckets, TABLE_BUCKETS)
        docs.withColumn("slice", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(number))) \
            .repartition(stored, "slice").write.option("compression", "zstd") \
            .option("path", scratch_path(self.spark, "slices")).bucketBy(stored, "slice").saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def each(self, work: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
        """Run ``work(slice, documents)`` on every slice."""
        def run(key, docs):
            return work(key[0].as_py(), docs)

        return self.table().groupBy("slice").applyInArrow(run, schema)

    def each_with(self, told: DataFrame, work: Callable[[int, pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
        """Run ``work(slice, documents, hashes)`` with the sorted hashes that ``told`` has for the slice."""
        def run(key, docs, hashes):
            raw, _ = as_bytes(hashes.column("hashes"))
            return work(key[0].as_py(), docs, np.sort(raw.view(np.uint64)))

        return self.table().groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(run, schema)


def ordered(docs: pa.Table) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Ids, texts and row numbers of a slice by doc_id, then text: a repeated row is a later document."""
    raw, off = as_bytes(docs.column("text"))
    data, off = raw.tobytes(), off.tolist()
    rows = sorted((i, data[a:b], n) for n, (i, a, b) in enumerate(
        zip(docs.column("doc_id").to_pylist(), off[:-1], off[1:], strict=True)))
    return np.array([r[0] for r in rows], np.int64), [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)


def planes(values: np.ndarray) -> bytes:
    """Bytes of a number column by significance, which compress far better than rows."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplaned(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def named(number: int, hashes: np.ndarray, buckets: int, doc: np.ndarray | None = None,
          pos: np.ndarray | None = None, by_doc: bool = False) -> pa.Table:
    """Rows that tell each bucket which hashes a slice has, whether twice, and where first.

    ``hashes`` stand in order of their places, so the first of equal ones is the earliest.
    The bucket comes from the hash, or ``by_doc`` from the value that goes with it.
    """
    h, first, count = np.unique(hashes, return_index=True, return_counts=True)
    bucket = ((doc[first].view(np.uint64) if by_doc else h) >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.diff(bucket[order], prepend=np.uint64(2 ** 63)))
    rows: dict[str, list] = {k: [] for k in ("bucket", "slice", "hashes", "twice", "doc", "pos")}
    for part in np.split(order, at[1:]) if len(order) else []:
        rows["bucket"].append(int(bucket[part[0]]))
        rows["slice"].append(number)
        rows["hashes"].append(h[part].tobytes())
        rows["twice"].append(np.packbits(count[part] > 1).tobytes())
        rows["doc"].append(None if doc is None else planes(doc[first[part]]))
        rows["pos"].append(None if pos is None else planes(pos[first[part]]))
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.table([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows))


TOLD = "slice long, hashes binary"


def _told(rows: pa.Table, sizes: list[int], keep: np.ndarray, hashes: np.ndarray) -> pa.Table:
    slices, out = [], []
    begin = 0
    for number, n in zip(rows.column("slice").to_pylist(), sizes, strict=True):
        some = hashes[begin:begin + n][keep[begin:begin + n]]
        begin += n
        if len(some):
            slices.append(number)
            out.append(some.tobytes())
    return pa.table([pa.array(slices, pa.int64()), pa.array(out, pa.binary())], names=["slice", "hashes"])


def repeated(rows: DataFrame) -> DataFrame:
    """For each slice, those of its hashes that stand at two places or more, anywhere."""
    def run(table):
        own = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool)
                                for x, h in zip(table.column("twice").to_pylist(), own, strict=True)])
        h = np.concatenate(own)
        order = np.argsort(h)
        s = h[order]
        again = np.zeros(len(s), bool)
        again[1:] = s[1:] == s[:-1]
        again[:-1] |= again[1:]
        keep = twice
        keep[order[again]] = True
        return _told(table, [len(x) for x in own], keep, h)

    return rows.select("bucket", "slice", "hashes", "twice").groupBy("bucket").applyInArrow(run, TOLD)


#: Marks the hash of a cell whose windows its slice is to name.
OPEN = np.uint64(0xC2B2AE3D27D4EB4F)


def cells(rows: DataFrame) -> DataFrame:
    """For each slice: hashes that stand at two places or more, and, marked with OPEN, one
    place's of each hash whose group (the value that goes with it) has other hashes too."""
    def run(table):
        own = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool)
                                for x, h in zip(table.column("twice").to_pylist(), own, strict=True)])
        group = np.concatenate([unplaned(x, np.int64) for x in table.column("doc").to_pylist()])
        source = np.repeat(np.arange(len(own)), [len(x) for x in own])
        h = np.concatenate(own)
        order = np.lexsort((h, group))
        g, s = group[order], h[order]
        head = np.ones(len(s), bool)  # the first place of each hash
        head[1:] = (s[1:] != s[:-1]) | (g[1:] != g[:-1])
        start = np.ones(len(s), bool)
        start[1:] = g[1:] != g[:-1]
        number = np.cumsum(start) - 1
        mixed = np.bincount(number, weights=head)[number] > 1
        again = ~head
        again[:-1] |= ~head[1:]
        sure = order[again | twice[order]]
        named_by = order[head & mixed]
        who = np.concatenate([source[sure], source[named_by]])
        out = np.concatenate([h[sure], h[named_by] ^ OPEN])[np.argsort(who, kind="stable")]
        sizes = np.bincount(who, minlength=len(own)).tolist()
        return _told(table, sizes, np.ones(len(out), bool), out)

    return rows.select("bucket", "slice", "hashes", "twice", "doc").groupBy("bucket").applyInArrow(run, TOLD)


def late(rows: DataFrame) -> DataFrame:
    """For each slice, those of its hashes that another slice has earlier (smaller doc, of equal ones smaller slice)."""
    def run(table):
        own = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        doc = np.concatenate([unplaned(x, np.int64) for x in table.column("doc").to_pylist()])
        of = np.repeat(table.column("slice").to_numpy(), [len(x) for x in own])
        h = np.concatenate(own)
        order = np.lexsort((of, doc, h))
        s = h[order]
        keep = np.zeros(len(h), bool)
        keep[order[1:]] = s[1:] == s[:-1]
        return _told(table, [len(x) for x in own], keep, h)

    return rows.select("bucket", "slice", "hashes", "doc").groupBy("bucket").applyInArrow(run, TOLD)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values
