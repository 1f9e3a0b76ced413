"""Near-duplicates and repeated passages against brute force."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from cropcube.llm import anchors, simhash, suffixes
from cropcube.llm.components import components, forest, local_components
from tests.llm.brute import byte_dedup, simhash as plain_simhash, united, word_dedup


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    links = chain + [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(5, 5), (7, 3000), (3000, 7)]
    rows = links + [(None, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    low = united({x for p in links for x in p}, links)
    assert got == {n: low[n] for n in got} and set(got) >= {n for n in low if low[n] != n}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_local_components():
    a, b = np.array([9, 4, 7, 1]), np.array([4, 2, 7, 3])
    nodes, low = local_components(a, b)
    assert dict(zip(nodes.tolist(), low.tolist())) == {9: 2, 4: 2, 2: 2, 7: 7, 1: 1, 3: 1}
    assert sorted(zip(*(x.tolist() for x in forest(a, b)))) == [(3, 1), (4, 2), (9, 2)]


def test_bk_tree_finds_all():
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    near = np.array([s ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64)))
                     for s in seeds for _ in range(8)], np.uint64)
    values = np.unique(np.concatenate([seeds, near, rng.integers(0, 2 ** 63, 500, dtype=np.uint64), [0]]).astype(np.uint64))
    tree, keys = simhash.bk_tree(values)
    assert sorted(tree.tolist()) == values.tolist() and (np.diff(keys) > 0).all()
    for radius in (0, 2, 5):
        q, m = simhash.search(tree, keys, values, radius)
        got = sorted(zip(values[q].tolist(), tree[m].tolist()))
        want = sorted((int(x), int(y)) for x in values for y in values[np.bitwise_count(values ^ x) <= radius])
        assert got == want
    empty = simhash.bk_tree(values[:0])
    assert [len(x) for x in simhash.search(*empty, values, 2)] == [0, 0]


def _near_texts():
    rng = random.Random(8)
    rows = []
    for g in range(30):
        words = [f"W{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        for _ in range(rng.randrange(1, 6)):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            rows.append(" ".join(copy))
    return rows + ["", " \n", None, "one", "One two", "one two three", "ONE  two\tthree", "été ÉTÉ Été ете"]


def test_simhash_near_duplicates(spark, make_docs):
    texts = _near_texts()
    rows = [(i * 3 + 1, t, 5) for i, t in enumerate(texts)]
    docs = make_docs([*rows, rows[4], (None, "no id", 5)], "doc_id long, text string, component_id long")
    got = simhash.near_duplicates(docs, words=3, radius=2).collect()
    fps = {i: plain_simhash(t) for i, t, _ in rows}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    low = united(fps, links)
    want = [(i, fps[i], low[i]) for i in fps] + [(rows[4][0], fps[rows[4][0]], low[rows[4][0]])]
    assert sorted((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in got) == sorted(want)
    assert len(links) > 10
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_small_trees_and_blocks(spark, monkeypatch):
    """Shards cut into several trees and query blocks lose no link."""
    monkeypatch.setattr(simhash, "TREE_SIZE", 7)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 62, 6)
    fps = sorted({int(b) ^ (1 << int(i)) for b in base for i in rng.integers(0, 60, 25)})
    nodes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, node long")
    low = {r.node: r.component for r in components(simhash.near_links(nodes, 2)).collect()}
    want = united(range(len(fps)), [(i, j) for i in range(len(fps)) for j in range(i)
                                    if (fps[i] ^ fps[j]).bit_count() <= 2])
    assert {n: low.get(n, n) for n in want} == want


def test_no_exploded_table_is_broadcast(spark):
    """A query goes to many shards, which the estimate of the exploded table does not show."""
    nodes = spark.range(2000).select(F.xxhash64("id").alias("fp"), F.col("id").alias("node"))
    plan = simhash.near_links(nodes, 2)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "Broadcast" not in plan


def _passages(rng, alphabet):
    """Texts that share passages at all alignments, with repeats inside, and periodic ones."""
    def word():
        return "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 8)))
    shared = [" ".join(word() for _ in range(rng.randrange(10, 70))) for _ in range(12)]
    rows = []
    for _ in range(80):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(" ".join(word() for _ in range(rng.randrange(0, 25))))
            if rng.random() < 0.6:
                p = rng.choice(shared).split(" ")
                a = rng.randrange(len(p))
                parts.append(" ".join(p[a:a + rng.randrange(5, 70)]))
        rows.append(rng.choice([" ", "\n", "  ", " \t"]).join(parts))
    long = " ".join(word() for _ in range(400))
    rows += [long, long, long[:500], long[3:1500], "ab " * 60, "ab " * 61, "x" * 300, "x" * 130, "abcabc" * 40, "", " ", None]
    return rows


@pytest.mark.parametrize("block", [anchors.BLOCK_BYTES, 500])
def test_word_windows(make_docs, monkeypatch, block):
    monkeypatch.setattr(anchors, "BLOCK_BYTES", block)
    rows = _passages(random.Random(11), "abé")
    docs = make_docs([(1000 - i, t, "s", i) for i, t in enumerate(rows)] + [(None, rows[0], "s", 0)],
                     "doc_id long, text string, slice string, n_words int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in anchors.dedup(docs, 20).collect()}
    want = word_dedup(rows[::-1])
    assert got == {1001 - len(rows) + i: w for i, w in enumerate(want)}
    assert sum(w[1] for w in want) > 500


def test_word_windows_repeated_rows_and_empty(make_docs):
    text = " ".join(map(str, range(30)))
    docs = make_docs([(1, text), (1, text), (1, "other words"), (2, text)])
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in anchors.dedup(docs).collect())
    assert got == [(1, 2, 0), (1, 30, 0), (1, 30, 30), (2, 30, 30)]
    assert anchors.dedup(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        anchors.dedup(docs, 13)


@pytest.mark.parametrize("length,block", [(64, suffixes.BLOCK_BYTES), (64, 200), (400, 700), (400, suffixes.BLOCK_BYTES)])
def test_byte_strings(make_docs, monkeypatch, length, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    rows = _passages(random.Random(length + block), "abcé")
    docs = make_docs([(i, t, b"x") for i, t in enumerate(rows)] + [(None, rows[0], b"x")],
                     "doc_id long, text string, kept binary")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.dedup(docs, length).collect()}
    want = byte_dedup(rows, length)
    assert got == dict(enumerate(want))
    assert sum(w[1] for w in want) > 500


def test_byte_strings_repeated_rows_and_empty(make_docs):
    text = "".join(map(str, range(200)))
    docs = make_docs([(1, text), (1, text), (2, text[:399]), (3, None)])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.dedup(docs).collect())
    assert got == [(1, 490, 490, 1), (1, 490, 490, 1), (2, 399, 0, 0), (3, 0, 0, 0)]
    assert suffixes.dedup(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        suffixes.dedup(docs, 60)


def test_sql_of_the_fingerprints():
    """XXH64 in SQL: texts whose shingles have every length from 1 to 100 bytes, few words, none, and copies."""
    import duckdb
    import pandas as pd
    rng = random.Random(3)
    rows = [" ".join("é漢ab1"[rng.randrange(5)] * rng.randrange(1, n) for _ in range(rng.randrange(1, 30))) for n in range(2, 34) for _ in range(3)]
    rows += ["a" * n for n in range(1, 100)] + _near_texts()
    rows = [t for t in rows if t is None or "\x00" not in t]
    documents = pd.DataFrame({"doc_id": range(len(rows)), "text": pd.array(rows, dtype="string")})  # noqa: F841  read by DuckDB
    got = {i: (f, c) for i, f, c in duckdb.connect().sql(simhash.oracle()).fetchall()}
    fps = {i: plain_simhash(t) for i, t in enumerate(rows)}
    low = united(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert got == {i: (f"{fps[i]:016x}", low[i]) for i in fps}
