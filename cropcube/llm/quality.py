"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents and flattened into
arrays, through which all rows of a block walk at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.common import as_bytes, slices

SLICE_BYTES = 8 << 20
#: Labelled documents that the trees are fitted on (the smallest hashes of doc_id).
SAMPLE = 20_000
BINS, TREES, DEPTH, RATE, LEAF, PENALTY = 64, 80, 4, 0.15, 20, 1.0

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 above ASCII
_KIND[ord("a"):ord("z") + 1], _KIND[ord("A"):ord("Z") + 1], _KIND[ord("0"):ord("9") + 1] = 1, 2, 3
_KIND[[9, 10, 11, 12, 13, 32]], _KIND[128:] = 4, 5
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
NAMES = (["log_bytes", "lower", "upper", "digit", "space", "above_ascii", "entropy", "log_words", "word_mean", "word_std",
          "distinct_words", "top_word", "distinct_pairs", "single_letters", "long_words", "capitalised", "all_upper",
          "ends_in_mark", "log_lines", "distinct_lines", "line_mean", "lines_ending", "short_lines", "top_line"]
         + [f"mark_{m}" for m in _MARKS])


def statistics(raw: bytes) -> list[float]:
    """Statistics of one whole text, all finite; an empty text gives zeros."""
    n = len(raw)
    if not n:
        return [0.0] * len(NAMES)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=hist, minlength=6) / n
    share = hist[hist > 0] / n
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x]
    out = [np.log1p(n), *kinds[1:].tolist(), float(-(share * np.log2(share)).sum())]
    if words:
        size = np.fromiter(map(len, words), np.int64, len(words))
        m = len(words)
        out += [np.log1p(m), size.mean(), size.std(), len(set(words)) / m, max(Counter(words).values()) / m,
                len(set(zip(words, words[1:], strict=False))) / max(1, m - 1), (size == 1).mean(), (size > 15).mean(),
                sum(map(bytes.istitle, words)) / m, sum(map(bytes.isupper, words)) / m,
                sum(w[-1] in _MARKS for w in words) / m]
    else:
        out += [0.0] * 11
    if lines:
        size = np.fromiter(map(len, lines), np.int64, len(lines))
        k = len(lines)
        out += [np.log1p(k), len(set(lines)) / k, np.log1p(size.mean()), sum(x[-1] in b".!?" for x in lines) / k,
                (size < 30).mean(), max(Counter(lines).values()) / k]
    else:
        out += [0.0] * 6
    return [float(x) for x in out] + (hist[list(_MARKS)] / n).tolist()


def _features(column: pa.Array) -> np.ndarray:
    raw, off = as_bytes(column)
    data = raw.tobytes()
    rows = [statistics(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
    return np.array(rows, np.float64).reshape(-1, len(NAMES))


@dataclass
class Trees:
    """Complete binary trees as arrays [tree, node]; leaves hold the score in log-odds."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: all rows walk all trees level by level."""
        total = np.full(len(x), self.base)
        if len(self.feature):
            rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
            at = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.cut[trees, at])
            total = total + self.value[trees, at - (2 ** DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees on binned statistics with logistic loss.

    No rows give score 0.5 for all; rows of one label alone give a constant near it.
    """
    inner = 2 ** DEPTH - 1
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    none = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(y) or y.min() == y.max():
        return none
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    code = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    flat = code + np.arange(width) * BINS
    score = np.full(n, base)
    feature, cut, value = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        f, c = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, nodes = 2 ** level - 1, 2 ** level
            slot = ((at - first)[:, None] * (width * BINS) + flat).ravel()
            size = nodes * width * BINS
            g, h, k = (np.cumsum(np.bincount(slot, weights=np.repeat(w, width), minlength=size)
                                 .reshape(nodes, width, BINS), axis=2) for w in (grad, hess, np.ones(n)))
            tg, th, tk = g[:, :, -1:], h[:, :, -1:], k[:, :, -1:]
            gain = g ** 2 / (h + PENALTY) + (tg - g) ** 2 / (th - h + PENALTY) - tg ** 2 / (th + PENALTY)
            gain = np.where((k >= LEAF) & (tk - k >= LEAF), gain, 0).reshape(nodes, -1)
            best = gain.argmax(axis=1)
            for node in np.flatnonzero(gain.max(axis=1) > 1e-9).tolist():
                j, b = divmod(int(best[node]), BINS)
                if b < len(edges[j]):
                    f[first + node], c[first + node] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), f[at]] > c[at])
        leaf = at - inner
        g, h = (np.bincount(leaf, weights=w, minlength=inner + 1) for w in (grad, hess))
        v = -RATE * g / (h + PENALTY)
        score = score + v[leaf]
        feature.append(f)
        cut.append(c)
        value.append(v)
    return Trees(base, np.array(feature), np.array(cut), np.array(value))


def held_out(doc_id="doc_id"):
    """Rows that are never learned from: CRC-32 of doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on at most ``sample`` labelled documents that are not held out.

    Labels that are null, or whose doc_id is, are left out, and so are those of documents
    that ``docs`` lacks; of contradicting labels of one doc_id the higher count wins (a tie
    counts as 1).  Of the rows that repeat a doc_id one is learned from (that of the smallest
    text hash).  One row for each chosen doc_id comes back to the driver, as statistics, so
    ``sample`` bounds them: 20,000 rows are 9 MB.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("q")) \
        .where("doc_id is not null and q is not null").where(~held_out())
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = known.groupBy("doc_id").agg((F.avg("q") >= 0.5).cast("int").alias("label")) \
        .join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("text"))

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            x = _features(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), part.column("h"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["doc_id", "label", "h", "x"])

    one = rows.select("doc_id", "label", "h", "text").mapInArrow(run, "doc_id long, label int, h long, x binary") \
        .groupBy("doc_id").agg(F.min(F.struct("h", "x", "label")).alias("r"))
    got = sorted((r.doc_id, bytes(r.x), r.label) for r in one.select("doc_id", "r.x", "r.label").collect())
    x = np.frombuffer(b"".join(r[1] for r in got), np.float64).reshape(-1, len(NAMES))
    return fit(x, np.array([r[2] for r in got], np.float64))


def scores(docs: DataFrame, model: Trees) -> DataFrame:
    """``doc_id``, ``score`` (probability of label 1) and ``predicted`` (score at least 0.5).

    One row for each row in; null and empty texts are scored as texts without any word,
    null and repeated ids are kept, other columns are not read.  No shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            s = sent.value.score(_features(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def accepted(docs: DataFrame, model: Trees) -> DataFrame:
    """Rows of ``docs``, all columns, that the model predicts as label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            s = sent.value.score(_features(part.column("text")))
            yield part.filter(pa.array(s >= 0.5))

    return docs.mapInArrow(run, docs.schema)
