"""Best-fit packing with certified bin counts.

Documents are tokenised into pieces of at most ``capacity`` tokens.  The pieces
are dealt into groups of bounded size; each group is packed by best-fit
decreasing, and lower bounds from dual feasible functions certify its number of
sequences.  Groups with a gap between both exchange the documents of their
unfilled sequences in the next round, which deals them anew and reruns best-fit
decreasing; certified groups hand on only their emptiest sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.bytebpe import default_path, encoder
from cropcube.llm.common import slices, written

SLICE_BYTES = 4 << 20
CAPACITY = 2048
GROUP_PIECES = 50_000
ROUNDS = 6

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32.

    A document is its tokens and then ``end_id``; one of more than ``capacity`` is cut
    so that only the first piece may be shorter.  A null text is empty (one token, the
    end).  Null and repeated ids are kept: every row is a document of its own.
    """
    path = vocabulary or default_path()

    def run(batches):
        enc = encoder(path)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found: list[list[np.ndarray]] = [[] for _ in texts]
            for row, ids in enc.encode(texts):
                found[row].append(ids)
            rows, piece, start, length, crc = [], [], [], [], []
            end = np.array([end_id], "<u4")
            for row, own in enumerate(found):
                ids = np.concatenate([*own, end]).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                begin = 0
                for k, to in enumerate(range(first, len(ids) + 1, capacity)):
                    rows.append(row)
                    piece.append(k)
                    start.append(begin)
                    length.append(to - begin)
                    crc.append(zlib.crc32(ids[begin:to].tobytes()))
                    begin = to
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first, each into the fullest bin that has room.

    ``room`` has bit g set while some bin has exactly g free, so the best fit is the
    lowest bit at or above the length.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    room, made = 0, 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = room >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            to = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                room ^= 1 << gap
        else:
            gap, to, made = capacity, made, made + 1
        bins[i], offsets[i] = to, capacity - gap
        if gap > size:
            open_by_gap[gap - size].append(to)
            room |= 1 << (gap - size)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of bins that dual feasible functions prove, for any packing.

    Two families: for each e up to half the capacity, lengths over capacity - e count
    as a whole bin and lengths under e as nothing; for each k, a length x counts as
    floor((k+1)x / capacity) / k bins unless (k+1)x is a multiple of the capacity.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    number, mass = np.cumsum(count), np.cumsum(count * size)
    e = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - e]
    middle = mass[capacity - e] - mass[e - 1]
    best = int(max(-(-mass[-1] // capacity), (whole - (-middle // capacity)).max()))
    for k in range(1, 101):
        steps = (k + 1) * size
        # in units of 1 / (capacity * k) bins
        value = np.where(steps % capacity == 0, size * k, steps // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    return best


#: Columns that :func:`pack` adds; input columns of these names are replaced.
PLACED = ("sequence_id", "offset", "certified")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Add ``sequence_id``, ``offset`` and ``certified`` (its group met the lower bound) to pieces.

    ``pieces`` is a stored table with a column ``length`` from 1 to ``capacity``; every row is
    placed exactly once, repeated rows too.  An empty table gives an empty result.  Pieces are
    dealt by their number in the table, so groups hold about ``group_pieces`` each whatever
    the input and however often a row repeats.  Other columns are carried, whatever their
    names; those that :func:`pack` adds replace columns of their names.
    """
    columns = [c for c in pieces.columns if c not in PLACED]
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    carried = pieces.select(F.col("length").cast("long").alias("size"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    fields = "size long, " + "".join(f"c{i} {kinds[c]}, " for i, c in enumerate(columns))
    schema = f"{fields}sequence_id long, offset long, certified boolean, settled boolean"

    def packer(turn: int, last: bool):
        def run(key, rows):
            rows = rows.drop(columns="dealt").reset_index(drop=True)
            length = rows["size"].to_numpy(np.int64)
            bins, offset = best_fit_decreasing(length, capacity)
            fill = np.bincount(bins, weights=length).astype(np.int64)
            certified = len(fill) == lower_bound(length, capacity)
            settled = np.ones(len(fill), bool) if last else fill == capacity
            if certified and not last:
                settled[:] = True
                if fill.min() < capacity:
                    settled[fill.argmin()] = False
            rows["sequence_id"] = (np.int64(turn) << 56) + (np.int64(key[0]) << 24) + bins
            rows["offset"] = offset
            rows["certified"] = bool(certified)
            rows["settled"] = settled[bins]
            return rows
        return run

    out: DataFrame | None = None
    pool, left = carried, pieces.count()
    own = carried.columns
    for turn in range(rounds):
        groups = max(1, -(-left // group_pieces))
        last = turn == rounds - 1
        dealt = pool.select(*own).withColumn("dealt", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups)))
        turned = written(dealt.groupBy("dealt").applyInPandas(packer(turn, last), schema), f"pack-{turn}")
        kept = turned.where("settled").drop("settled")
        out = kept if out is None else out.unionByName(kept)
        pool = turned.where("not settled")
        if last:
            break
        was, left = left, pool.count()
        if not left:
            break
        if groups == 1 or left == was:  # alone in one group, or no exchange would help: settle as packed
            out = out.unionByName(pool.drop("settled"))
            break
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], *PLACED)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and pack a document table: the columns of :func:`token_pieces` and of :func:`pack`.

    The pieces are written first, so that texts are tokenised once.
    """
    return pack(written(token_pieces(docs, vocabulary, capacity), "pieces"), capacity)
