"""Vector code compression: product codebooks by member-resident Lloyd rounds.

Every vector is cut into equal parts; each part position has a codebook of its own.  The
parts live with the entry that they belong to, in blocks dealt by (position, entry, salt).
A round works on the blocks where they are: owners sum their resident members, the sums
(one row for each block) give the new entries, and members are compared with them in
place.  Members that keep their entry stay in their block; only those that change entry
are shuffled, to the blocks of their new owner.  The salt follows from the number of
vectors, so a position whose parts all fall to one entry still has blocks of bounded size.

Components are whole numbers.  While all are below 2**22, distances are exact in doubles;
larger ones are computed with Python's integers.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.common import drop_written, parts as shuffle_parts, scratch_path, written
from cropcube.llm.vectors import usable

#: Members of an owner that share a salt (about), and rows that a task compares at once.
OWNED, AT_ONCE = 20_000, 2_048
EXACT = 1 << 22
LONGEST = (1 << 63) - 1

BLOCK = "position int, entry int, salt int, members int, rows binary, parts binary"


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles as int64, or as Python integers where that is too small."""
    if not x.size or np.abs(x).max() < 2.0 ** 62 / scale:
        return np.floor(scale * x).astype(np.int64)
    out = [int(v) * scale if abs(v) >= 2.0 ** 52 else int(np.floor(scale * v)) for v in x.ravel().tolist()]
    return np.array(out, object).reshape(x.shape)


def nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (of equal ones the first) and the squared distance."""
    if members.dtype == object or book.dtype == object or max(np.abs(members).max(initial=0), np.abs(book).max(initial=0)) >= EXACT:
        d = ((members.astype(object)[:, None] - book.astype(object)[None]) ** 2).sum(axis=2)
        best = np.array([row.index(min(row)) for row in d.tolist()], np.int64)
        return best, d[np.arange(len(best)), best] if len(best) else np.zeros(0, object)
    m, b = members.astype(np.float64), book.astype(np.float64)
    d = (m * m).sum(axis=1)[:, None] - 2 * (m @ b.T) + (b * b).sum(axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(best)), best].astype(np.int64)


def _dump(x: np.ndarray) -> bytes:
    """A matrix of whole numbers in the smallest type that holds it: type character, then bytes."""
    if x.dtype == object:
        return b"O" + "\n".join(map(str, x.ravel().tolist())).encode()
    kind = next(k for k in (np.int16, np.int32, np.int64) if not x.size or (x.min() >= np.iinfo(k).min and x.max() <= np.iinfo(k).max))
    return np.dtype(kind).char.encode() + np.ascontiguousarray(x, kind).tobytes()


def _load(raw: bytes, width: int) -> np.ndarray:
    if raw[:1] == b"O":
        return np.array([int(v) for v in raw[1:].split(b"\n")], object).reshape(-1, width)
    return np.frombuffer(raw, np.dtype(raw[:1].decode()), offset=1).reshape(-1, width)


def _join(blocks: list[np.ndarray]) -> np.ndarray:
    big = any(b.dtype == object for b in blocks)
    return np.concatenate([b.astype(object) if big else b.astype(np.int64) for b in blocks])


def _grouped(position: int, entry: np.ndarray, rows: np.ndarray, members: np.ndarray, salts: int) -> Iterator[tuple]:
    """Blocks of members by entry and salt."""
    salt = (rows.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(salts)
    key = entry.astype(np.int64) * salts + salt.astype(np.int64)
    order = np.argsort(key, kind="stable")
    for pick in np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else ():
        k = int(key[pick[0]])
        yield position, k // salts, k % salts, len(pick), rows[pick].tobytes(), _dump(members[pick])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _enter(books: list[np.ndarray], scale: int, salts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors to blocks of their parts, dealt by the first codebooks."""
    count, width = len(books), books[0].shape[1]
    for batch in batches:
        for i in range(0, batch.num_rows, 4 * AT_ONCE):
            some = batch.slice(i, 4 * AT_ONCE)
            v = whole(some.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, count * width), scale)
            rows = some.column("row").to_numpy()
            out = []
            for p in range(count):
                part = v[:, p * width:(p + 1) * width]
                best = np.concatenate([nearest(part[j:j + AT_ONCE], books[p])[0] for j in range(0, len(part), AT_ONCE)])
                out += _grouped(p, best, rows, part, salts)
            yield _batch(out, BLOCK)


def _settle(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that arrive in a partition, merged by owner up to the size that is compared at once."""
    held: dict[tuple, list] = {}
    for batch in batches:
        out = []
        for p, e, s, n, rows, members in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            have = held.setdefault((p, e, s), [])
            have.append((n, rows, members))
            if sum(x[0] for x in have) >= AT_ONCE:
                out.append(_merged((p, e, s), held.pop((p, e, s)), width))
        if out:
            yield _batch(out, BLOCK)
    if held:
        yield _batch([_merged(k, x, width) for k, x in held.items()], BLOCK)


def _merged(key: tuple, have: list, width: int) -> tuple:
    return *key, sum(x[0] for x in have), b"".join(x[1] for x in have), _dump(_join([_load(x[2], width) for x in have]))


SUMS = "position int, entry int, place int, limb int, total long, members long"
#: Sums beyond 62 bits are told in limbs of this many bits, the last one with the sign.
LIMB = 48


def _limbs(total: int) -> list[int]:
    if abs(total) < 1 << 62:
        return [total]
    return [total & (1 << LIMB) - 1, *_limbs(total >> LIMB)]


def _sums(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the resident members of each owner in this task."""
    sums: dict[tuple, list] = {}
    for batch in batches:
        for p, e, n, raw in zip(*(batch.column(c).to_pylist() for c in ("position", "entry", "members", "parts")), strict=True):
            members = _load(raw, width)
            total = members.sum(axis=0, dtype=object if members.dtype == object or np.abs(members).max() >= 1 << 40 else np.int64)
            had = sums.setdefault((p, e), [0, [0] * width])
            had[0] += n
            had[1] = [a + b for a, b in zip(had[1], total.tolist(), strict=True)]
    yield _batch([(p, e, i, k, x, 0 if k else n) for (p, e), (n, total) in sums.items()
                  for i, t in enumerate(total) for k, x in enumerate(_limbs(t))], SUMS)


MOVED = BLOCK + ", moved boolean"


def _reassign(books: list[np.ndarray], salts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block without the members that leave it, and those, by their new owners, marked as moved."""
    width = books[0].shape[1]
    for batch in batches:
        out = []
        for p, e, s, n, rows, raw in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            members, ids = _load(raw, width), np.frombuffer(rows, np.int64)
            best = np.concatenate([nearest(members[i:i + AT_ONCE], books[p])[0] for i in range(0, n, AT_ONCE)])
            stay = best == e
            if stay.all():
                out.append((p, e, s, n, rows, raw, False))
                continue
            if stay.any():
                out.append((p, e, s, int(stay.sum()), ids[stay].tobytes(), _dump(members[stay]), False))
            out += [(*x, True) for x in _grouped(p, best[~stay], ids[~stay], members[~stay], salts)]
        if out:
            yield _batch(out, MOVED)


CODES = "row long, position int, entry int, error long"


def _codes(books: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest entry of each resident part and its squared distance."""
    width = books[0].shape[1]
    for batch in batches:
        for p, n, rows, raw in zip(*(batch.column(c).to_pylist() for c in ("position", "members", "rows", "parts")), strict=True):
            members, ids = _load(raw, width), np.frombuffer(rows, np.int64)
            for i in range(0, n, AT_ONCE):
                best, far = nearest(members[i:i + AT_ONCE], books[p])
                far = np.array([min(x, LONGEST) for x in far.tolist()], np.int64) if far.dtype == object else far
                yield pa.record_batch({"row": pa.array(ids[i:i + AT_ONCE]), "position": pa.array(np.full(len(best), p), pa.int32()),
                                       "entry": pa.array(best, pa.int32()), "error": pa.array(far)})


class Codes:
    """What :func:`compress` returns: ``rows`` (vec_id, label, code, error, label_error) and ``books``,
    a list of integer matrices (entries x components) by part position."""

    def __init__(self, rows: DataFrame, books: list[np.ndarray]):
        self.rows, self.books = rows, books

    def digest(self) -> str:
        """sha256 (hex) of all components by part, entry and place, as decimals joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def _updated(books: list[np.ndarray], blocks: DataFrame) -> list[np.ndarray]:
    """Codebooks whose used entries are floor(sum / count) of their resident members."""
    found = blocks.mapInArrow(functools.partial(_sums, books[0].shape[1]), SUMS).groupBy("position", "entry", "place", "limb") \
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members")) \
        .collect()  # some rows for each component of an entry, whatever the number of vectors
    sums: dict[tuple, list[int]] = {}
    for r in found:
        total = sums.setdefault((r.position, r.entry, r.place), [0, 0])
        total[0] += int(r.total) << LIMB * r.limb
        total[1] += r.members
    new = [b.astype(object) for b in books]
    for (p, e, i), (total, n) in sums.items():
        new[p][e, i] = total // n
    small = all(abs(int(x)) < 1 << 62 for b in new for x in b.ravel())
    return [b.astype(np.int64) if small else b for b in new]


def _dealt(blocks: DataFrame, width: int) -> DataFrame:
    """Blocks shuffled to their owners and merged there."""
    return blocks.repartition("position", "entry", "salt").mapInArrow(functools.partial(_settle, width), BLOCK)


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
             key: str = "vec_id", vector: str = "embedding", label: str = "label") -> Codes:
    """Codes of all vectors by codebooks of ``rounds`` Lloyd rounds, one for each of ``parts`` equal parts.

    Components are floor(scale * x).  A codebook starts as that part of the ``entries``
    smallest keys (of equal keys the smaller vector first, null keys last; fewer vectors,
    fewer entries).  A round assigns every part to the nearest entry by squared distance (of
    equal ones the first) and replaces each used entry by the floor of the mean; then all are
    assigned again.  ``code`` has the entry of each part, ``error`` the squared distances
    summed, ``label_error`` the errors summed over rows of equal label, nulls together.

    Vectors that are null or hold null or non-finite components are left out.  So are those of
    another length than most have: of the lengths that ``parts`` divides, the commonest, of
    equally common ones the longest.  Repeated rows and repeated or null keys are rows of their
    own; other columns are not read; an empty table gives no rows and no codebooks.  Errors
    beyond a long's range are given as its largest value.
    """
    kind = vectors.schema[vector].dataType.simpleString()
    v = F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")
    kept = vectors.where(usable(vector)).select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("v"))
    sizes = kept.groupBy(F.size("v").alias("n")).count().where((F.col("n") > 0) & (F.col("n") % parts == 0)) \
        .orderBy(F.col("count").desc(), F.col("n").desc()).first()
    out = {"vec_id": "long", "label": vectors.schema[label].dataType.simpleString(), "code": "array<int>", "error": "long",
           "label_error": "long"}
    if sizes is None:
        return Codes(vectors.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in out.items())), [])
    width = sizes["n"] // parts
    base = written(kept.where(F.size("v") == sizes["n"]).withColumn("row", F.monotonically_increasing_id()), "vectors")
    first = base.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    start = whole(np.array(first.column("v").to_pylist(), np.float64), scale)
    books = [start[:, p * width:(p + 1) * width] for p in range(parts)]
    salts = max(1, -(-sizes["count"] // OWNED))
    blocks = written(_dealt(base.select("row", "v").mapInArrow(functools.partial(_enter, books, scale, salts), BLOCK), width), "owned")
    for r in range(rounds):
        books = _updated(books, blocks)
        if r + 1 == rounds:
            break
        path = scratch_path(base.sparkSession, "assigned")
        blocks.mapInArrow(functools.partial(_reassign, books, salts), MOVED).write.partitionBy("moved").parquet(path)
        told = base.sparkSession.read.schema(MOVED).parquet(path)
        arrived = written(_dealt(told.where("moved").drop("moved"), width), "moved")
        drop_written(blocks)
        blocks = told.where("NOT moved").drop("moved").unionByName(arrived)
    found = blocks.mapInArrow(functools.partial(_codes, books), CODES).groupBy("row") \
        .agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("error"),
             F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: x["entry"]).alias("code"))
    coded = written(base.select("row", "vec_id", "label").join(found, "row"), "coded")
    longest = F.lit(LONGEST).cast("decimal(38,0)")
    salted = shuffle_parts(base.sparkSession)
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salted - 1))))
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salted)).cast("int")) \
        .join(by_label.withColumnRenamed("salt", "of_salt"), F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")))
    return Codes(rows.select("vec_id", "label", "code", F.least("error", longest).cast("long").alias("error"),
                             F.least("label_error", longest).cast("long").alias("label_error")), books)


def oracle(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """DuckDB SQL for :func:`compress` over the table ``embeddings``, whose vectors have one length."""
    steps = [f"""
kept AS (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (
  SELECT row, vec_id, v AS whole, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v
  FROM (SELECT *, unnest(range({parts})) AS p FROM kept)),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST, whole) - 1 AS e, v AS c
  FROM part QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST, whole) <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS (
  SELECT row, p, e, v, list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c) AS d
  FROM part JOIN book{r} USING (p) QUALIFY row_number() OVER (PARTITION BY row, p ORDER BY d, e) = 1)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (
  SELECT p, e, list(c ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(x) / count(*)) AS c FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{r})
    GROUP BY p, e, i) GROUP BY p, e),
book{r + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m USING (p, e))""")
    steps.append(f"""
code AS (
  SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY row),
books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS sha
  FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM book{rounds}))""")
    return "WITH " + ",".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM kept JOIN code USING (row), books"""
