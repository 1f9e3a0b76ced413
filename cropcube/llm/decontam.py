"""Benchmark decontamination by a prefix-filtered join of word shingles.

A window is ``window`` consecutive words of a benchmark item, or the whole of a shorter
item.  Its shingles of four words are ordered by how often the documents hold them.  As
an occurrence must contain every shingle of the window, one necessary token is enough as
its prefix: the rarest.  Documents are probed with the prefix tokens only.  A hit at word
p for a token that stands at word o of a window of m words leaves one place, p - o, which
must lie inside the document (positional and length bounds).  There the hash of the m
words names a window, and the words themselves are compared byte by byte.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.common import as_bytes, mix64, prefix_sums, ragged, slices, span_hash, written

SHINGLE = 4
#: Windows that one pass over the documents looks for; more take more passes.
PASS_WINDOWS = 200_000
BLOCK_BYTES = 4 << 20

#: Bytes of words as they are compared; a blank for all others.
_WORD = np.full(256, 32, np.uint8)
_WORD[128:] = np.arange(128, 256)
for _low, _high, _move in (("0", "9", 0), ("a", "z", 0), ("A", "Z", 32)):
    _WORD[ord(_low):ord(_high) + 1] = np.arange(ord(_low), ord(_high) + 1) + _move


class Words:
    """The words of some texts: lower-cased bytes with one blank after each, and hashes."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        text = _WORD[raw]
        on = text != 32
        edge = np.zeros(len(raw) + 1, bool)
        edge[off] = True  # words end with their text
        edge[1:-1] |= on[1:] != on[:-1]
        edge = np.flatnonzero(edge)
        s, e = edge[:-1], edge[1:]
        word = on[s]
        self.begin, size = s[word], (e - s)[word]
        self.doc = np.searchsorted(off, self.begin, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(off) - 1)
        self.first = np.cumsum(self.count) - self.count
        self.last = self.first + self.count
        values = (text.astype(np.uint64) + np.uint64(0x51ED)) * np.uint64(0xA24BAED4963EE407)
        self.sums = prefix_sums(span_hash(prefix_sums(values ^ (values >> np.uint64(29))), self.begin, self.begin + size))
        self.at = np.append(0, np.cumsum(size + 1))  # of each word among the compared bytes
        self.bytes = np.full(int(self.at[-1]) + 1, 32, np.uint8)
        self.bytes[ragged(self.at[:-1], size)] = text[ragged(self.begin, size)]

    def starts(self, length: int) -> np.ndarray:
        """Words at which ``length`` words of one text start."""
        at = np.arange(len(self.doc))
        return at[at + length <= self.last[self.doc]]

    def hash(self, start: np.ndarray, length: int) -> np.ndarray:
        return span_hash(self.sums, start, start + length)

    def same(self, start: np.ndarray, length: int, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the ``length`` words at each start equal the bytes text[begin:end]."""
        a, b = self.at[start], self.at[start + length]
        ok = b - a == end - begin
        size = (b - a)[ok]
        if len(size):
            equal = self.bytes[ragged(a[ok], size)] == text[ragged(begin[ok], size)]
            ok[ok] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
        return ok


def _windows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of items: length in words, words (a blank after each) and item."""
    for batch in slices(batches, "text", BLOCK_BYTES):
        w = Words(*as_bytes(batch.column("text")))
        start = np.arange(len(w.doc))
        length = np.minimum(window, w.count[w.doc])
        start, length = (x[start + length <= w.last[w.doc]] for x in (start, length))
        for some in np.array_split(np.arange(len(start)), -(-len(start) // 20_000) or 1):
            a, b = w.at[start[some]], w.at[start[some] + length[some]]
            size = b - a
            words = pa.Array.from_buffers(pa.large_binary(), len(some), [
                None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int64)), pa.py_buffer(w.bytes[ragged(a, size)])])
            yield pa.record_batch({"length": pa.array(length[some], pa.int32()), "words": words.cast(pa.binary()),
                                   "item": batch.column("item").take(pa.array(w.doc[start[some]]))})


class Index:
    """Windows by hash, with their bytes, shingles and items; arrays only, so it is sent as it is."""

    def __init__(self, rows: pa.Table):
        rows = rows.group_by("words").aggregate([("item", "list")]).combine_chunks()
        raw, off = as_bytes(rows.column("words"))
        w = Words(raw, off)
        self.items = rows.column("item_list")
        self.text, self.begin, self.end = w.bytes, w.at[w.first], w.at[w.last]
        self.length = w.count
        self.lengths = [int(n) for n in np.unique(self.length)]
        key = np.zeros(len(off) - 1, np.uint64)
        for n in self.lengths:
            pick = np.flatnonzero(self.length == n)
            key[pick] = w.hash(w.first[pick], n)
        key ^= mix64(self.length.astype(np.uint64))
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]
        # the shingles of each window: a short window is one shingle of its own length
        self.own, self.offset, self.token, self.size = [], [], [], []
        for n in self.lengths:
            k = min(SHINGLE, n)
            pick = np.flatnonzero(self.length == n)
            for o in range(n - k + 1):
                self.own.append(pick)
                self.offset.append(np.full(len(pick), o))
                self.token.append(w.hash(w.first[pick] + o, k) ^ mix64(np.full(len(pick), k, np.uint64)))
                self.size.append(np.full(len(pick), k))
        kinds = (np.int64, np.int64, np.uint64, np.int64)
        self.own, self.offset, self.token, self.size = (np.concatenate([np.zeros(0, kind), *x]) for kind, x in zip(
            kinds, (self.own, self.offset, self.token, self.size), strict=True))

    def tokens(self) -> dict[int, np.ndarray]:
        """Sorted shingles by their number of words."""
        return {int(k): np.unique(self.token[self.size == k]) for k in np.unique(self.size)}

    def prefixes(self, tokens: dict[int, np.ndarray], counted: pa.Table) -> None:
        """Keep of each window its rarest shingle by the counts (of equal ones the smaller hash)."""
        known = np.unique(np.concatenate([*tokens.values(), np.zeros(0, np.uint64)]))
        much = np.zeros(len(known), np.int64)
        much[np.searchsorted(known, counted.column("token").to_numpy().view(np.uint64))] = counted.column("n").to_numpy()
        n = much[np.searchsorted(known, self.token)]
        order = np.lexsort((self.offset, self.token, n, self.own))
        first = order[np.diff(self.own[order], prepend=-1) != 0]
        token, offset, length, size = self.token[first], self.offset[first], self.length[self.own[first]], self.size[first]
        # windows that share their token, its place and their length are one probe
        rows = np.unique(np.stack([size.astype(np.uint64), token, offset.astype(np.uint64), length.astype(np.uint64)], axis=1), axis=0)
        self.probes = {int(k): rows[rows[:, 0] == k][:, 1:] for k in np.unique(rows[:, 0])}
        del self.own, self.offset, self.token, self.size


def _filter(tokens: np.ndarray) -> np.ndarray:
    """A table of bits of the tokens' leading bits, which most shingles of documents miss."""
    table = np.zeros(1 << 20, bool)
    table[(tokens >> np.uint64(44)).astype(np.int64)] = True
    return table


def _found(values: np.ndarray, tokens: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` that are among the sorted tokens, and which they are."""
    at = np.flatnonzero(table[(values >> np.uint64(44)).astype(np.int64)])
    k = np.minimum(np.searchsorted(tokens, values[at]), len(tokens) - 1)
    ok = tokens[k] == values[at]
    return at[ok], k[ok]


def _cut(text: bytes, overlap: int) -> Iterator[tuple[Words, int]]:
    """Parts of a long text and the number of their first word; each has the last ``overlap`` words of the one before."""
    at = first = 0
    while True:
        to, w = at, None
        while to < len(text) and (w is None or len(w.doc) <= 2 * overlap):
            to = min(len(text), to + BLOCK_BYTES)
            while to < len(text) and _WORD[text[to]] != 32:
                to += 1
            w = Words(np.frombuffer(text[at:to], np.uint8), np.array([0, to - at]))
        yield w, first
        if to >= len(text):
            return
        first += len(w.doc) - overlap
        at = to if not overlap else at + int(w.begin[len(w.doc) - overlap])


def _parts(batches: Iterator[pa.RecordBatch], overlap: int):
    """(batch, words, number of the first word, whether the batch ends here); a long text comes in several parts."""
    for batch in slices(batches, "text", BLOCK_BYTES):
        raw, off = as_bytes(batch.column("text"))
        if batch.num_rows > 1 or len(raw) <= 2 * BLOCK_BYTES:
            yield batch, Words(raw, off), 0, True
            continue
        held = None
        for part in _cut(raw.tobytes(), overlap):
            if held:
                yield batch, *held, False
            held = part
        yield batch, *held, True


def _count(tokens: dict[int, np.ndarray], overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often these documents hold each token, those that they hold."""
    counts = {k: np.zeros(len(t), np.int64) for k, t in tokens.items()}
    tables = {k: _filter(t) for k, t in tokens.items()}
    for _, w, _, last in _parts(batches, overlap):
        for k, t in tokens.items():
            start = w.starts(k)
            start = start if last else start[start < len(w.doc) - overlap]
            _, which = _found(w.hash(start, k) ^ mix64(np.full(1, k, np.uint64)), t, tables[k])
            counts[k] += np.bincount(which, minlength=len(t))
    for k, t in tokens.items():
        some = counts[k] > 0
        yield pa.record_batch({"token": pa.array(t[some].view(np.int64)), "n": pa.array(counts[k][some])})


def _hits(index: Index, tables: dict, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts of occurrences among the words and the windows that stand there."""
    starts, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, rows in index.probes.items():
        tokens, table = tables[k]
        place = w.starts(k)
        at, token = _found(w.hash(place, k) ^ mix64(np.full(1, k, np.uint64)), tokens, table)
        at = place[at]
        low, high = np.searchsorted(rows[:, 0], tokens[token], "left"), np.searchsorted(rows[:, 0], tokens[token], "right")
        probe = ragged(low, high - low)
        start = np.repeat(at, high - low) - rows[probe, 1].astype(np.int64)
        length = rows[probe, 2].astype(np.int64)
        doc = np.repeat(w.doc[at], high - low)
        ok = (start >= w.first[doc]) & (start + length <= w.last[doc])
        start, length = start[ok], length[ok]
        for n in np.unique(length):
            s = np.unique(start[length == n])
            h = w.hash(s, int(n)) ^ mix64(np.full(1, n, np.uint64))
            low, high = np.searchsorted(index.key, h, "left"), np.searchsorted(index.key, h, "right")
            own = index.order[ragged(low, high - low)]
            s = np.repeat(s, high - low)
            ok = index.length[own] == n
            own, s = own[ok], s[ok]
            ok = w.same(s, int(n), index.text, index.begin[own], index.end[own])
            starts.append(s[ok])
            which.append(own[ok])
    return np.concatenate(starts), np.concatenate(which)


FOUND = "n_words long, spans array<struct<start:long,end:long>>, item_ids array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _probe(index: Index, overlap: int, carry: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's number of words, with the runs of hit words and the items found added to those it has."""
    tables = {k: (t := np.unique(rows[:, 0]), _filter(t)) for k, rows in index.probes.items()}
    said: list = []
    for batch, w, first, last in _parts(batches, overlap):
        start, own = _hits(index, tables, w)
        doc = w.doc[start]
        said.append((doc, start - w.first[doc] + first, start - w.first[doc] + first + index.length[own], own))
        if not last:
            continue
        doc, start, end, own = (np.concatenate(x) for x in zip(*said, strict=True))
        said = []
        had, n = batch.column("spans"), batch.num_rows
        who = np.repeat(np.arange(n), had.value_lengths().to_numpy())
        start, end = (np.concatenate([x, had.flatten().field(c).to_numpy()]) for x, c in ((start, "start"), (end, "end")))
        runs = _union(np.concatenate([doc, who]), start, end)
        items = batch.column("item_ids").to_pylist()
        pairs = np.unique(np.stack([doc, own], axis=1), axis=0)
        for i in np.unique(pairs[:, 0]):
            more = {x for k in pairs[pairs[:, 0] == i, 1].tolist() for x in index.items[k].as_py() if x is not None}
            items[i] = sorted(more.union(items[i]))
        spans = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(np.bincount(runs[0], minlength=n))), pa.int32()),
            pa.StructArray.from_arrays([pa.array(x) for x in runs[1:]], names=["start", "end"]))
        count = w.count if first == 0 else np.array([first + len(w.doc)])
        yield pa.record_batch({**{c: batch.column(c) for c in carry}, "n_words": pa.array(count, pa.int64()),
                               "spans": spans.cast(_SPANS), "item_ids": pa.array(items, pa.list_(pa.string()))})


def _union(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs that the spans of each document cover: document, start, end."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    reach = np.maximum.accumulate((doc << 40) + end) if len(doc) else end
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] << 40) + start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(first) else first
    return doc[first], start[first], reach[last] - (doc[first] << 40)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """doc_id, n_words, spans and item_ids of every document.

    Words are runs of digits, ASCII letters (A-Z lower-cased) and all code points beyond
    ASCII.  ``spans`` are the maximal runs [start, end) of words that lie inside an
    occurrence of a benchmark window, ``item_ids`` the items (as strings, sorted) that have
    an occurring window.  Occurrences are exact; windows never cross documents.

    A null, empty or wordless text has no words, spans or items; a benchmark text without
    words has no windows; windows of an item without item_id count as hits and name no
    item.  Repeated rows, null doc_ids and ties stay as they are, a row for each document;
    other columns are not read, and an empty table gives an empty result or no hits.

    Documents are read where they lie, without a shuffle, twice for each ``pass_windows``
    distinct (window, item): once to count the windows' shingles over all documents, once
    to probe.  What the driver and a task hold of the benchmark is bounded by that.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    windows = items.mapInArrow(functools.partial(_windows, window), "length int, words binary, item string") \
        .select("words", "item").distinct().withColumn("deal", F.xxhash64("words", "item"))
    windows = written(windows, "benchmark-windows")
    passes = max(1, -(-windows.count() // pass_windows))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.from_json(F.lit("[]"), "array<struct<start:long,end:long>>").alias("spans"),
                        F.array().cast("array<string>").alias("item_ids"))
    for i in range(passes):
        index = Index(windows.where(F.pmod("deal", F.lit(passes)) == i).select("words", "item").toArrow())
        tokens = index.tokens()
        counted = found.select("text").mapInArrow(functools.partial(_count, tokens, window - 1), "token long, n long") \
            .groupBy("token").agg(F.sum("n").alias("n")).toArrow()
        index.prefixes(tokens, counted)
        carry = ["doc_id"] + ["text"] * (i + 1 < passes)
        schema = "doc_id long, " + "text string, " * (i + 1 < passes) + FOUND
        found = found.mapInArrow(functools.partial(_probe, index, window - 1, carry), schema)
        if i + 1 < passes:
            found = written(found, "contaminated")
    return found


ORACLE = r"""
WITH t AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
w AS (
  SELECT kind, row, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
items AS (
  SELECT id, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p, w FROM w WHERE kind = 'b' AND len(w) > 0),
windows AS (SELECT DISTINCT m, list_slice(w, p, p + m - 1) AS k, id FROM items),
sizes AS (SELECT DISTINCT m FROM windows),
places AS (SELECT row, m, unnest(range(1, len(w) - m + 2)) AS p, w FROM w, sizes WHERE kind = 'd' AND len(w) >= m),
hits AS (
  SELECT row, p, places.m, windows.id FROM places JOIN windows ON places.m = windows.m AND list_slice(w, p, p + places.m - 1) = k),
marked AS (SELECT row, count(DISTINCT i) AS n FROM (SELECT row, unnest(range(p, p + m)) AS i FROM hits) GROUP BY row),
named AS (
  SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, CAST(id AS VARCHAR) AS id FROM hits WHERE id IS NOT NULL) GROUP BY row)
SELECT w.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(marked.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(marked.n, 0) > 0 AS contaminated
FROM w LEFT JOIN marked USING (row) LEFT JOIN named USING (row) WHERE kind = 'd'"""
