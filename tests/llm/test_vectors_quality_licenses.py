"""Vector operators, quality classifier, licence scan and the pipeline."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cropcube.llm import licenses, quality, rpforest, topk
from cropcube.llm.vectors import usable
from tests.llm.brute import simhash, united, word_dedup
from tests.llm.test_bpe import check_packed

VECTORS = "vec_id long, embedding array<float>, label int, v int, id int"
NAN, INF = float("nan"), float("inf")


def _odd_vectors():
    return [(9000, None, 1, 0, 0), (9050, [1.0, None], 1, 0, 0), (9100, [NAN, 1.0], 1, 0, 0), (9150, [INF, 1.0], 1, 0, 0),
            (9200, [], 1, 0, 0), (None, [1.0, 0.0], 1, 0, 0)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    base = rng.standard_normal((40, 16))
    near = base[rng.integers(0, 40, 300)] + rng.standard_normal((300, 16)) * rng.choice([0, 0.05, 0.2, 0.5], (300, 1))
    rows = [(i, [float(np.float32(x)) for x in v], int(i % 3) if i % 17 else None, 0, 0) for i, v in enumerate(near)]
    rows += [(500 + i, rows[3][1], rows[3][2], 0, 0) for i in range(30)]
    return rows + [(600, [0.0] * 16, 1, 0, 0), (650, [1.0, 2.0], 1, 0, 0), (651, [1.0, 2.1], 1, 0, 0)]


def _top(spark, rows, k=5):
    e = spark.createDataFrame(rows, VECTORS).where(F.col("vec_id").isNotNull() & usable("embedding"))
    whole = e.select("vec_id", F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double")).alias("v"))
    return topk.top_k(whole, whole.where(F.col("vec_id") % 50 == 0), k).collect()


def test_top_k(spark, vectors, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 3)
    got = {}
    for r in _top(spark, vectors + _odd_vectors() + [vectors[5]]):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v, *_ in vectors}
    for q in [i for i in whole if i % 50 == 0]:
        best = sorted((-int(whole[q] @ w), i) for i, w in whole.items() if i != q and len(w) == len(whole[q]))[:5]
        assert sorted(got.pop(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert not got  # the empty vector 9200 has no candidate of its length
    assert _top(spark, []) == []


def test_branch_and_bound_drops_candidates():
    rng = np.random.default_rng(0)
    m = np.floor(rng.standard_normal((64, 2000)) * 50)
    q = m[:, 7].copy()
    square = np.vstack([np.cumsum((m ** 2)[::-1], axis=0)[::-1], np.zeros((1, 2000))])
    live, total = topk.best(q, m, np.sqrt(square[[*range(0, 64, 8), 64]]), np.zeros(2000, bool), 5)
    assert len(live) < 100 and set(np.argsort(-(q @ m))[:5]) <= set(live)
    assert (total == q @ m[:, live]).all()


@pytest.mark.parametrize("block", [rpforest.BLOCK, 20])
def test_forest(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(rpforest, "BLOCK", block)
    monkeypatch.setattr(rpforest, "LEAF", 40)
    rows = vectors + _odd_vectors() + [vectors[5]]
    got = rpforest.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    n, links = dict.fromkeys([r[0] for r in rows if r[0] is not None], 0), []
    for i, v, l, *_ in vectors:
        for j, w, k, *_ in vectors:
            if i < j and l == k and l is not None and len(v) == len(w) and any(v) and any(w):
                a, b = np.array(v), np.array(w)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                    links.append((i, j))
                    n[i], n[j] = n[i] + 1, n[j] + 1
    low = united(n, links)
    assert len(got) == len([r for r in rows if r[0] is not None])
    found = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert all(found[i][0] <= n[i] for i in n)  # nothing below the threshold
    assert sum(f[0] for f in found.values()) >= 0.99 * sum(n.values()) and len(links) > 400
    assert sum(found[i][1] != low[i] for i in n) <= 2
    assert rpforest.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_forest_keeps_dense_groups_whole(spark, monkeypatch):
    """A third of all vectors differ slightly from each other, more of them than a leaf or the sample holds."""
    monkeypatch.setattr(rpforest, "SAMPLE", 800)
    monkeypatch.setattr(rpforest, "LEAF", 32)
    rng = np.random.default_rng(5)
    v = rng.standard_normal((2400, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    group = np.arange(2400) % 3 == 1
    v[group] = v[0] + 0.1 * v[group]
    rows = [(i, [float(np.float32(x)) for x in w], 1, 0, 0) for i, w in enumerate(v)]
    got = {r.vec_id: r for r in rpforest.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    w = np.array([r[1] for r in rows])
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    near = (w @ w.T >= 0.93).sum(axis=1) - 1
    assert (near[group] >= 799).all()
    assert [got[i].n_links for i in np.flatnonzero(group)] == near[group].tolist()
    assert {got[i].component_id for i in np.flatnonzero(group)} == {0}


def test_quality(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(5, 90))]
        rows.append((i, " ".join(w) + "." if good else "!! ".join(x.upper() for x in w) + " | $$$", 3.0))
        labels.append((i, int(good), 9))
    rows += [(7000, None, 0.0), (7001, "", 0.0), (None, "text", 0.0), (3, rows[3][1], 0.0), (7002, "word " * 50_000, 0.0)]
    labels += [(8000, 1, 9), (None, 0, 9), (5, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    known = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    model = quality.train(docs, known)
    got = quality.scores(docs, model).withColumn("held_out", quality.held_out()).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert sum(r.predicted == labels[r.doc_id][1] for r in held) / len(held) > 0.98 and len(held) > 150
    stay = quality.accepted(docs, model)
    assert stay.columns == docs.columns and stay.count() == sum(r.predicted for r in got)
    # held-out labels are never read
    flipped = known.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.train(docs, flipped).value, model.value)
    # the bound on the sample holds, and too little to learn from gives a constant
    assert len(quality.train(docs, known, sample=1).feature) == 0
    none = quality.train(docs, known.limit(0))
    assert {r.score for r in quality.scores(docs, none).collect()} == {0.5}
    assert quality.scores(docs.limit(0), none).collect() == []


def _license_rows():
    rng = random.Random(9)
    rows = []
    for i in range(120):
        w = [f"word{rng.randrange(500)}" for _ in range(rng.randrange(0, 80))]
        if rng.random() < 0.7:
            t = rng.choice(licenses.TEMPLATES)[1].split(" ")
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() for x in t] if rng.random() < 0.3 else t
        rows.append((i, rng.choice([" ", "\n", ", "]).join(w), "x"))
    return rows + [(500, None, "x"), (501, "", "x"), (502, "!!", "x"), (3, rows[3][1], "x"), (503, "Released under the MIT", "x"),
                   (504, " ".join(f"w{i}" for i in range(40_000)) + " released under the mit license", "x")]


def test_licenses_equal_exact_containment(spark, tmp_path):
    rows = _license_rows()
    spark.createDataFrame(rows, "doc_id long, text string, license string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    frame = licenses.scan(docs)
    got = sorted((r.doc_id, r.license, r.containment, r.first_word) for r in frame.collect())
    con = duckdb.connect()
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841  read by DuckDB
    assert got == sorted(con.sql(licenses.oracle()).fetchall()) and len(got) > 40
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
    assert licenses.scan(docs.limit(0)).collect() == []


def test_license_relatives_are_told_apart(spark, make_docs):
    """Each text is found whole under its own name, and no relative of it is whole too."""
    texts = dict(licenses.TEMPLATES)
    names = ["mit", "mit-0", "bsd-2-clause", "bsd-3-clause", "isc", "0bsd", "gpl-2.0-notice", "gpl-3.0-notice",
             "lgpl-3.0-notice", "agpl-3.0-notice", "gpl-2.0-or-later-header", "gpl-3.0-or-later-header",
             "lgpl-2.1-or-later-header", "lgpl-3.0-or-later-header", "agpl-3.0-or-later-header", "gpl-2.0", "gpl-3.0",
             "lgpl-2.1", "lgpl-3.0", "cc-by-4.0", "cc-by-nc-sa-4.0"]
    assert set(names) <= set(texts)
    found = {i: {} for i in range(len(names))}
    for r in licenses.scan(make_docs([(i, "some words before " + texts[n] + " and after") for i, n in enumerate(names)])) \
            .collect():
        found[r.doc_id][r.license] = r.containment
    parts = ("-opening", "-header", "-notice")
    for i, n in enumerate(names):
        others = {k for k, v in found[i].items() if v == 1 and k != n}
        assert found[i][n] == 1 and all(k.endswith("-opening" if n.endswith(parts) else parts) for k in others), (n, found[i])
    assert found[names.index("agpl-3.0-or-later-header")]["gpl-3.0-or-later-header"] < 0.9


def test_license_band_settings():
    """For every size of template, the chance to escape all bands is under one in a million."""
    for n in range(1, 200):
        c = 1 << (n - 1).bit_length()
        window, _ = licenses.window_size(c)
        held = -(-n * 8 // 10)
        similarity = held / (window + n - held)
        assert (1 - similarity) ** licenses.BANDS < 1e-6


def _pipeline_brute(docs, accepted):
    rows = {r.doc_id: r for r in docs if r.doc_id in accepted}
    fps = {i: simhash(r.text) for i, r in rows.items()}
    low = united(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    stay = sorted(i for i in rows if low[i] == i)
    cut = word_dedup([rows[i].text for i in stay])
    return [(i, c[2] if c[1] else rows[i].text, c[1]) for i, c in zip(stay, cut)]


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    shared = " ".join(f"s{rng.randrange(900)}" for _ in range(60))
    rows = []
    for i in range(150):
        w = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 120)))
        w = w + "\n" + shared + "." if rng.random() < 0.3 else w
        if i % 5 == 4:
            w = "!! ".join(w.upper().split()) + " | $$$"
        rows.append((2 * i, w, "en", "s", len(w), "extra"))
    rows += [(1000 + i, rows[i][1], "en", "s", 1, "copy") for i in range(20)] + [(2000, None, "en", "s", None, None)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], int("!!" not in (r[1] or "")), 0) for r in rows if r[1]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now, sf = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    table = now.collect()
    accepted = {r.doc_id for r in corpus_pipeline.classify(spark, now, sf).collect()}
    assert {r[0] for r in labels if r[1]} <= accepted and not {r[0] for r in labels if not r[1]} & accepted
    want = _pipeline_brute(table, accepted)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == docs.columns
    kept = now.collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(w[:2] for w in want)
    assert all(r.n_chars == len(r.text) for r in kept if dict((w[0], w[2]) for w in want)[r.doc_id])
    assert all(r.component_id in ("extra", None, "copy") for r in kept) and sum(w[2] for w in want) > 100
    packed = corpus_pipeline.run(spark, sf).collect()
    check_packed(packed, kept, 2048)
    empty = f"{tmp_path}/empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []
