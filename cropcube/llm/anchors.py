"""Substring dedup of word windows with difference-cover anchors.

Any two places, however they stand modulo the period, have an offset below the
period at which both are at cover positions.  So two equal windows of 20 words share
a short window of 8 words that starts at a cover position of both; only those are
hashed and compared across the corpus.  Where an anchor is repeated, all windows
of 20 words around it are compared, and each keeps only its first place.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cropcube.llm.common import prefix_sums, span_hash, written
from cropcube.llm.slicing import NAMED, Slices, among, late, named, ordered, repeated

#: Differences of these cover all residues modulo 13 (a perfect difference set).
PERIOD, COVER = 13, (0, 1, 3, 9)
BLOCK_BYTES = 4 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SPACE = re.compile(rb"[\x09-\x0d\x20]")


def _blocks(texts: list[bytes]):
    """(document of each piece, pieces) of bounded size; long texts are cut at white space."""
    who, out, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text) or not at:
            to = len(text)
            if to - at > BLOCK_BYTES and (cut := _SPACE.search(text, at + BLOCK_BYTES)):
                to = cut.end()
            if out and size + to - at > BLOCK_BYTES:
                yield who, out
                who, out, size = [], [], 0
            who.append(i)
            out.append(text[at:to])
            size += to - at
            at = to
            if not text:
                break
    if out:
        yield who, out


class Words:
    """Hashes of all words of a slice in order, and each document's first word and number of words."""

    def __init__(self, texts: list[bytes]):
        found, count = [], np.zeros(len(texts), np.int64)
        for who, pieces in _blocks(texts):
            raw = np.frombuffer(b" ".join(pieces) + b" ", np.uint8)
            blank = _BLANK[raw]
            edge = np.flatnonzero(np.diff(blank, prepend=True))
            s, e = edge[::2], edge[1::2]
            values = (raw.astype(np.uint64) + np.uint64(0x3C6F)) * np.uint64(0x9FB21C651E98DF25)
            found.append(span_hash(prefix_sums(values ^ (values >> np.uint64(31))), s, e))
            first = np.cumsum([0] + [len(p) + 1 for p in pieces[:-1]])
            np.add.at(count, np.array(who)[np.searchsorted(first, s, side="right") - 1], 1)
        self.count = count
        self.first = np.cumsum(count) - count
        self.sums = prefix_sums(np.concatenate([*found, np.zeros(0, np.uint64)]))
        self.doc = np.repeat(np.arange(len(texts)), count)
        self.pos = np.arange(int(count.sum())) - self.first[self.doc]

    def windows(self, length: int) -> np.ndarray:
        """Numbers of the words at which a window of ``length`` words starts."""
        return np.flatnonzero(self.pos + length <= self.count[self.doc])

    def hash(self, starts: np.ndarray, length: int) -> np.ndarray:
        return span_hash(self.sums, starts, starts + length)

    def anchors(self, window: int) -> np.ndarray:
        """Starts at cover positions of documents that have a whole window."""
        at = self.windows(window - PERIOD + 1)
        return at[np.isin(self.pos[at] % PERIOD, COVER) & (self.count[self.doc[at]] >= window)]


def dedup(docs: DataFrame, window: int = 20, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space) of every document.

    With ``carry`` come also ``original`` (the text as it was) and carry_0, carry_1, ...:
    the named columns of the input, unchanged.

    Words are runs of bytes other than 0x20 and 0x09-0x0D.  A word goes if a window of
    ``window`` words that covers it also starts earlier: in a smaller doc_id, or earlier
    in its own document.  Windows are judged on the input.  A null, empty or blank text
    has no words; rows without a doc_id have no place in the order and are left out; a
    repeated row counts as a later document.  Other columns are not read.

    Windows are compared by 64-bit hashes of their words, and only where an anchor hash,
    an independent one, is repeated too.  ``window`` must exceed the period of 13.
    """
    if window <= PERIOD:
        raise ValueError(f"window must exceed {PERIOD} words")
    slices = Slices(docs, carry=carry)
    buckets, short = slices.buckets, window - PERIOD + 1

    def tell_anchors(number, table):
        words = Words(ordered(table)[1])
        return named(number, words.hash(words.anchors(window), short), buckets)

    def tell_windows(number, table, shared):
        if not len(shared):
            return named(number, np.zeros(0, np.uint64), buckets)
        ids, texts, _ = ordered(table)
        words = Words(texts)
        at = words.anchors(window)
        near = np.zeros(len(words.doc) + 1, np.int64)
        near[at[among(words.hash(at, short), shared)] + 1] = 1
        near = np.cumsum(near)
        at = words.windows(window)
        at = at[near[at + PERIOD] > near[at]]  # an anchor at one of the first 13 words
        return named(number, words.hash(at, window), buckets, ids[words.doc[at]], words.pos[at].astype(np.int32))

    def cut(number, table, gone):
        ids, texts, order = ordered(table)
        words = Words(texts)
        at = words.windows(window)
        h = words.hash(at, window)
        again = np.ones(len(h), bool)
        again[np.unique(h, return_index=True)[1]] = False  # the first place in the slice
        at = at[again | among(h, gone)]
        change = np.zeros(len(words.doc) + window + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
        removed = np.cumsum(change)[:len(words.doc)] > 0
        lost = np.bincount(words.doc, weights=removed, minlength=len(ids)).astype(np.int64)
        kept = []
        for text, first, n, gone_here in zip(texts, words.first.tolist(), words.count.tolist(), lost.tolist(), strict=True):
            parts = text.split()
            if gone_here:
                parts = [parts[i] for i in np.flatnonzero(~removed[first:first + n]).tolist()]
            kept.append(b" ".join(parts))
        out = {"doc_id": pa.array(ids), "n_words": pa.array(words.count), "n_removed": pa.array(lost),
               "text": pa.array(kept, pa.binary()).cast(pa.string())}
        if carry:
            out["original"] = table.column("text").take(pa.array(order))
            out |= {f"carry_{i}": table.column(f"carry_{i}").take(pa.array(order)) for i in range(len(carry))}
        return pa.table(out)

    schema = "doc_id long, n_words long, n_removed long, text string"
    if carry:
        schema += ", original string" + "".join(
            f", carry_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    shared = written(repeated(slices.each(tell_anchors, NAMED)), "shared-anchors")
    gone = written(late(slices.each_with(shared, tell_windows, NAMED)), "late-windows")
    return slices.each_with(gone, cut, schema)
