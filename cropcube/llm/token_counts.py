"""Token counts by the whole-token shortcut.

Before any text is read, every string of the vocabulary is merged alone; those
that give one token are proven whole.  A pre-token that equals a proven string
counts 1 without merging; only the rest are merged, each distinct one once.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.bytebpe import TABLE_WORDS, default_path, vocabulary
from cropcube.llm.common import slices
from cropcube.llm.pretokens import END_MARK, blocks, spans

SLICE_BYTES = 4 << 20


class Counter:
    """Counts tokens; holds the proven strings and the counts of merged words met so far."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.special = next(iter(self.v.special), None)
        self.proven_keys, self.proven = self._prove()
        self.clear()

    def _prove(self) -> tuple[np.ndarray, int]:
        """Hashes of the vocabulary strings that are one pre-token and one token."""
        strings = []
        for i, token in enumerate(self.v.tokens):
            try:
                strings.append((i, token, token.decode()))
            except UnicodeDecodeError:
                continue  # part of a character: never a pre-token
        strings = [x for x in strings if x[1] and x[0] not in self.v.special.values()]
        alone = self.v.merge_all([x[1] for x in strings])
        whole = [x[2] for x, ids in zip(strings, alone, strict=True) if ids == [x[0]]]
        _, _, h, piece = spans(END_MARK.join(whole) + END_MARK)
        single = np.bincount(piece, minlength=len(whole))[piece] == 1
        return np.unique(h[single]), int(single.sum())

    def clear(self) -> None:
        special = np.zeros(1 if self.special else 0, np.uint64)
        self.keys = np.unique(np.concatenate([self.proven_keys, special]))
        self.counts = np.ones(len(self.keys), np.int64)
        self.merged = 0

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        for rows, joined in blocks(texts, self.special):
            if len(self.keys) > TABLE_WORDS:
                self.clear()
            s, e, h, piece = spans(joined)
            if not len(s):
                continue
            known, first, back = np.unique(h, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.keys, known), len(self.keys) - 1)
            new = np.flatnonzero(self.keys[at] != known)
            if len(new):
                who = first[new]
                words = [joined[a:b].encode() for a, b in zip(s[who].tolist(), e[who].tolist(), strict=True)]
                counts = np.array([len(x) for x in self.v.merge_all(words)], np.int64)
                place = np.searchsorted(self.keys, known[new])
                self.keys, self.counts = np.insert(self.keys, place, known[new]), np.insert(self.counts, place, counts)
                self.merged += len(new)
                at = np.searchsorted(self.keys, known)
            per_token = self.counts[at][back]
            np.add.at(total, rows, np.bincount(piece, weights=per_token, minlength=len(rows)).astype(np.int64))
        return total


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary_path: str | None = None, limit: int = 1024) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every whole text.

    A null text counts as empty (0 bytes, 0 tokens).  One row out for each row in,
    null and repeated ids included; other columns are not read.  No shuffle.
    """
    path = vocabulary_path or default_path()

    def run(batches):
        count = counter(path).count
        for part in slices(batches, "text", SLICE_BYTES):
            col = part.column("text")
            tokens = count([t or "" for t in col.to_pylist()])
            size = pc.fill_null(pc.binary_length(col), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), size, pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
