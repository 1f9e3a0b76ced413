"""Suffix dedup by bucket-pointer refinement.

A suffix's bucket is named by the string it starts with.  Buckets of 25 bytes are
refined by the bucket identifiers of later offsets: those of 50 bytes pair the
identifiers at p and p + 25, those of 100 bytes pair the new ones at p and p + 50,
and so on, each update reused by the next.  Across the corpus, buckets are sorted
at three of these stages, and what is alone in its bucket retires:

1. 100 bytes, at anchors: in each window of 400 bytes, the 100 bytes with the
   smallest identifier, so equal windows have equal anchors at equal offsets;
2. cells: up to 32 neighbouring windows with one anchor.  If the string that all of
   them cover (outer) stands elsewhere, so do all of them; if not even the string that
   they share (inner) does, none of them does;
3. 400 bytes, only where cells share the inner string but not the outer one, which are
   the ends of repeated passages: one place for each outer string names its windows.

Stages compare slices of documents through buckets (see slicing), so a passage held
by a third of all documents costs one entry for each slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cropcube.llm.common import mix64, prefix_sums, span_hash, written
from cropcube.llm.slicing import NAMED, OPEN, Slices, among, cells, named, ordered, repeated

BLOCK_BYTES = 1 << 20
CELL = 32
_TURN = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                                0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def _pair(x: np.ndarray, y: np.ndarray, level: int) -> np.ndarray:
    """Identifier of a string from those of two strings that make it up."""
    z = x * _TURN[level] + y
    return z ^ (z >> np.uint64(32))


class Block:
    """Some pieces of documents side by side, with bucket identifiers of all offsets.

    ``length`` is the window: 400, or any multiple of 16 of at least 64 (stages halve it).
    """

    def __init__(self, pieces: list[tuple[int, int, bytes, int, int]], length: int):
        self.length, quarter = length, length // 4
        self.raw = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        size = np.array([len(p[2]) for p in pieces])
        self.doc, self.offset = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
        self.begin = np.cumsum(size) - size
        self.end = self.begin + size
        first, last = self.begin + [p[3] for p in pieces], self.begin + [p[4] for p in pieces]
        at = np.zeros(len(self.raw) + 1, np.int8)
        np.add.at(at, first, 1)
        np.add.at(at, last, -1)
        self.windows = np.flatnonzero(np.cumsum(at[:-1], dtype=np.int8) > 0)
        step = quarter // 4
        values = (self.raw.astype(np.uint64) + np.uint64(0x2545)) * np.uint64(0xD1342543DE82EF95)
        sums = prefix_sums(values ^ (values >> np.uint64(30)))
        start = np.arange(len(self.raw) - step + 1)
        ids = span_hash(sums, start, start + step)
        for level in (0, 1):
            ids = _pair(ids[:-step], ids[step:], level)
            step *= 2
        self.quarter = ids
        self.anchor = self._anchors(length - quarter + 1)

    def _anchors(self, width: int) -> np.ndarray:
        """For each window, the leftmost offset of the smallest identifier of a quarter window."""
        low, where, have = self.quarter, np.arange(len(self.quarter), dtype=np.int32), 1
        while have < width:
            step = min(have, width - have)
            right = low[step:] < low[:-step]
            where = np.where(right, where[step:], where[:-step])
            low = np.where(right, low[step:], low[:-step])
            have += step
        return where[self.windows].astype(np.int64)

    def half(self) -> np.ndarray:
        q = self.length // 4
        return _pair(self.quarter[:-q], self.quarter[q:], 2)

    def whole(self, half: np.ndarray) -> np.ndarray:
        h = self.length // 2
        return _pair(half[:-h], half[h:], 3)


class Cells:
    """Cells of the windows of a block whose anchors are shared: ranges of window offsets."""

    def __init__(self, block: Block, shared: np.ndarray):
        w, a = block.windows, block.anchor
        new = np.flatnonzero(np.diff(a, prepend=-1))
        hit = among(block.quarter[a[new]], shared)
        live = np.repeat(hit, np.diff(np.append(new, len(a))))
        w, a = w[live], a[live]
        c = (a - w) // CELL
        new = np.flatnonzero(np.diff(a * 64 + c, prepend=-1)) if len(w) else np.zeros(0, np.int64)
        self.first, self.anchor, self.cell = w[new], a[new], c[new]
        self.last = w[np.append(new[1:], len(w)) - 1] if len(new) else new
        self.piece = np.searchsorted(block.begin, self.first, side="right") - 1
        if not len(new):
            self.inner = self.outer = np.zeros(0, np.uint64)
            self.half = None
            return
        self.half = block.half()
        whole, half, n = block.whole(self.half), block.length // 2, block.length
        base = self.anchor - CELL * self.cell
        self.inner = _pair(_pair(self.half[base], self.half[base + (n - CELL + 1) - half], 4), self.cell.astype(np.uint64), 5)
        s = np.maximum(base - CELL + 1, block.begin[self.piece])
        e = np.minimum(base + n, block.end[self.piece])
        # with the cell's number, else two anchors would name one string at one place
        shape = ((self.cell * 1024 + base - s) * 1024 + e - base).astype(np.uint64)
        self.outer = _pair(_pair(whole[s], whole[e - n], 4), shape, 5)


def _marks(docs: np.ndarray) -> np.ndarray:
    """Hashes by which a slice tells its later passes which of its documents matter."""
    return mix64(docs.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def _blocks(texts: list[bytes], length: int, told: np.ndarray | None = None):
    """Blocks of bounded size, of all documents or of those that ``told`` marks.

    A long document is cut by window starts, with margins around.
    """
    pieces, size = [], 0
    wanted = np.ones(len(texts), bool) if told is None else among(_marks(np.arange(len(texts))), told)
    for i, text in enumerate(texts):
        if len(text) < length or not wanted[i]:
            continue
        for at in range(0, len(text) - length + 1, BLOCK_BYTES):
            to = min(at + BLOCK_BYTES, len(text) - length + 1)
            left = max(0, at - CELL + 1)
            piece = text[left:min(len(text), to + length - 1 + CELL - 1)]
            if pieces and size + len(piece) > BLOCK_BYTES:
                yield Block(pieces, length)
                pieces, size = [], 0
            pieces.append((i, left, piece, at - left, to - left))
            size += len(piece)
    if pieces:
        yield Block(pieces, length)


def _once(doc: list, place: list, hashes: list) -> np.ndarray:
    """Hashes of distinct places: what two pieces of a long document both name counts once."""
    if not hashes:
        return np.zeros(0, np.uint64)
    key = np.concatenate(doc) << 44 | np.concatenate(place)
    return np.concatenate(hashes)[np.unique(key, return_index=True)[1]]


def dedup(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every document.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else,
    in the same document or another; strings never cross documents, overlapping places
    count, and all are judged on the input.  ``n_spans`` counts maximal removed runs,
    ``kept`` is the rest.  A null text is empty; rows without a doc_id are left out;
    repeated rows are documents of their own, and so repeat each other.  Other columns
    are not read.  Strings are compared by 64-bit identifiers, and only where their
    anchors, which have others, are shared.
    """
    if length < 64 or length % 16:
        raise ValueError("length must be a multiple of 16 of at least 64")
    slices = Slices(docs)
    buckets = slices.buckets

    def tell_anchors(number, table):
        doc, place, found = [], [], []
        for b in _blocks(ordered(table)[1], length):
            at = b.anchor[np.flatnonzero(np.diff(b.anchor, prepend=-1))]
            piece = np.searchsorted(b.begin, at, side="right") - 1
            doc.append(b.doc[piece])
            place.append(at - b.begin[piece] + b.offset[piece])
            found.append(b.quarter[at])
        return named(number, _once(doc, place, found), buckets)

    def tell_cells(number, table, told):
        doc, place, inner, outer = [], [], [], []
        for b in _blocks(ordered(table)[1], length) if len(told) else ():
            c = Cells(b, told)
            doc.append(b.doc[c.piece])
            place.append((c.anchor - b.begin[c.piece] + b.offset[c.piece]) * 64 + c.cell)
            inner.append(c.inner)
            outer.append(c.outer)
        inner, outer = _once(doc, place, inner), _once(doc, place, outer)
        marks = np.repeat(_marks(np.unique(np.concatenate([*doc, np.zeros(0, np.int64)]))), 2)  # twice: they come back
        # an outer string holds its inner one, so equal outer ones stand in one bucket
        return named(number, np.concatenate([outer, marks]), buckets,
                     np.concatenate([inner, marks]).view(np.int64), by_doc=True)

    def open_windows(b: Block, told: np.ndarray):
        """Cells, which of them are surely repeated, and windows (offset, identifier) of the open ones."""
        c = Cells(b, told)
        sure = among(c.outer, told)
        left = np.flatnonzero(among(c.outer ^ OPEN, told))
        if not len(left):
            return c, sure, left, np.zeros(0, np.uint64)
        count = c.last[left] - c.first[left] + 1
        at = np.repeat(c.first[left], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return c, sure, at, _pair(c.half[at], c.half[at + length // 2], 3)

    def tell_windows(number, table, told):
        found = [open_windows(b, told)[3] for b in _blocks(ordered(table)[1], length, told)] if len(told) else []
        return named(number, np.concatenate([*found, np.zeros(0, np.uint64)]), buckets)

    def cut(number, table, told):
        ids, texts, _ = ordered(table)
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size) - size
        change = np.zeros(int(size.sum()) + 1, np.int32)
        for b in _blocks(texts, length, told) if len(told) else ():
            c, sure, at, ids_at = open_windows(b, told)
            at = at[among(ids_at, told)]
            for first, last in ((c.first[sure], c.last[sure]), (at, at)):
                piece = np.searchsorted(b.begin, first, side="right") - 1
                move = begin[b.doc[piece]] + b.offset[piece] - b.begin[piece]
                np.add.at(change, first + move, 1)
                np.add.at(change, last + move + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        starts = gone.copy()
        starts[1:] &= ~gone[:-1]
        first = begin[size > 0]
        starts[first] = gone[first]  # runs end with their document
        total, runs = (np.append(0, np.cumsum(x)) for x in (gone, starts))
        n_removed, n_spans = (t[begin + size] - t[begin] for t in (total, runs))
        raw = np.frombuffer(b"".join(texts), np.uint8)
        kept = [t if not n else raw[a:a + len(t)][~gone[a:a + len(t)]].tobytes()
                for t, a, n in zip(texts, begin.tolist(), n_removed.tolist(), strict=True)]
        return pa.table([pa.array(ids), pa.array(size), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                         pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    told = written(repeated(slices.each(tell_anchors, NAMED)), "shared-anchors")
    told = told.unionByName(written(cells(slices.each_with(told, tell_cells, NAMED)), "shared-cells"))
    told = told.unionByName(written(repeated(slices.each_with(told, tell_windows, NAMED)), "shared-windows"))
    return slices.each_with(told, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
