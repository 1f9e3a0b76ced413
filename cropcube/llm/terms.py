"""Terms of texts, counted by length-bucketed packing.

A term is a run of letters: ASCII letters, of which only A-Z are lower-cased, and all
code points beyond ASCII.  Terms of up to 8 bytes become one 64-bit word and those of up
to 16 bytes two (no term has a zero byte, so padding is unambiguous); both are radix
sorted by 16-bit digits and counted as runs.  Longer terms go to a bucket for each power
of two of their length, sorted as bytes.  All sorts are stable and documents stand by
group, so a run holds its occurrences group by group and document by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cropcube.llm.common import as_bytes, ragged, slices

BLOCK_BYTES = 8 << 20
PIECE_BYTES = 32 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("A"):ord("Z") + 1] = _LETTER[128:] = True
#: Big-endian mask of the first n bytes of a word.
_FIRST = np.array([((1 << 64) - 1) ^ ((1 << 64 - 8 * n) - 1) for n in range(9)], np.uint64)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by unsigned 64-bit words, the first word leading."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]  # numpy sorts 16 bits by radix
    return order


def _packed(text: np.ndarray, start: np.ndarray, length: np.ndarray, count: int) -> list[np.ndarray]:
    """The bytes of each term as ``count`` big-endian words, padded with zeros."""
    at = np.ndarray(len(text) - 7, ">u8", text.data, strides=(1,))
    return [at[start + 8 * i].astype(np.uint64) & _FIRST[np.clip(length - 8 * i, 0, 8)] for i in range(count)]


def _runs(new: list[np.ndarray], doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, number of places and number of documents of each run of one term and group.

    ``new`` holds arrays whose changes begin another term.
    """
    begins = np.zeros(len(doc), bool)
    begins[:1] = True
    for x in [*new, group]:
        begins[1:] |= x[1:] != x[:-1]
    other = begins.copy()
    other[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(begins)
    return first, np.diff(np.append(first, len(doc))), np.add.reduceat(other, first, dtype=np.int64)


def count_terms(raw: np.ndarray, off: np.ndarray, group: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, groups, occurrences, documents) by length bucket, a row for each term and group.

    Documents are ``raw[off[i]:off[i + 1]]`` and stand in order of ``group``.
    """
    letter = _LETTER[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True  # terms end with their document
    edge[1:-1] |= letter[1:] != letter[:-1]
    edge = np.flatnonzero(edge)
    s, e = edge[:-1], edge[1:]
    term = letter[s]
    s, e = s[term], e[term]
    length = e - s
    doc = np.searchsorted(off, s, side="right") - 1
    text = np.concatenate([_LOWER[raw], np.zeros(16, np.uint8)])
    for low, high in ((1, 8), (9, 16)):
        pick = np.flatnonzero((length >= low) & (length <= high))
        if len(pick):
            words = _packed(text, s[pick], length[pick], high // 8)
            order = radix_order(words)
            pick, words = pick[order], [w[order] for w in words]
            yield _row(text, s, length, doc, group, pick, words)
    left = np.flatnonzero(length > 16)
    width = np.ceil(np.log2(np.maximum(length[left], 1))).astype(np.int64)
    for w in np.unique(width):
        pick = left[width == w]
        rows = np.zeros((len(pick), 1 << int(w)), np.uint8)
        rows[np.repeat(np.arange(len(pick)), length[pick]), ragged(np.zeros(len(pick), np.int64), length[pick])] = \
            text[ragged(s[pick], length[pick])]
        key = rows.view(f"S{1 << int(w)}").ravel()
        order = np.argsort(key, kind="stable")
        yield _row(text, s, length, doc, group, pick[order], [key[order]])


def _row(text, s, length, doc, group, pick, new):
    d = doc[pick]
    first, count, docs = _runs(new, d, group[d])
    one = pick[first]
    size = length[one]
    offsets = np.append(0, np.cumsum(size)).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_string(), len(one), [None, pa.py_buffer(offsets), pa.py_buffer(text[ragged(s[one], size)])])
    return terms, group[d[first]], count, docs


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut between a byte that is no letter and the next, so that no term is cut."""
    at = 0
    while at < len(text):
        to = min(at + PIECE_BYTES, len(text))
        while to < len(text) and _LETTER[text[to - 1]]:
            to += 1
        yield text[at:to]
        at = to


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From lang, source and text without nulls: lang, source, term, n (occurrences) and docs.

    A row for each term and group of a block of texts; a text that is longer than a block
    is counted in pieces whose terms are then merged, so that it counts as one document.
    """
    for batch in slices(batches, "text", BLOCK_BYTES):
        lang, source = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
        key = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(source.dictionary) \
            + source.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(key, kind="stable")
        key = key[order]
        raw, off = as_bytes(batch.column("text").take(pa.array(order)))
        if batch.num_rows == 1 and len(raw) > PIECE_BYTES:
            found = _of_one(raw.tobytes())
        else:
            found = count_terms(raw, off, key)
        for terms, group, n, docs in found:
            yield pa.record_batch({
                "lang": lang.dictionary.take(pa.array(group // len(source.dictionary))),
                "source": source.dictionary.take(pa.array(group % len(source.dictionary))),
                "term": terms.cast(pa.string()), "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())})


def _of_one(text: bytes):
    merged = None
    for piece in _pieces(text):
        raw = np.frombuffer(piece, np.uint8)
        new = [pa.table({"term": t, "n": pa.array(n, pa.int64())})
               for t, _, n, _ in count_terms(raw, np.array([0, len(raw)]), np.zeros(1, np.int64))]
        merged = pa.concat_tables(([merged] if merged is not None else []) + new) if new else merged
        if merged is not None:
            merged = merged.group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
    if merged is not None:
        n = len(merged)
        yield merged.column("term").combine_chunks(), np.zeros(n, np.int64), merged.column("n").to_numpy(), np.ones(n, np.int64)
