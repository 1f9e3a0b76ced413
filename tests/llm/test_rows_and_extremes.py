"""Rows without an identity of their own, vectors of any magnitude, hot rows, bounded groups, own tables only."""

import functools
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from cropcube.llm import anchors, common, packing, quality, rpforest, simhash, suffixes, topk
from cropcube.llm.slicing import Slices
from tests.llm.brute import byte_dedup, united, word_dedup


def _text(rng, n=40):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_unrelated_rows_stay_through_near_dedup(spark, make_docs):
    rng = random.Random(1)
    rows = [(None, _text(rng), "a"), (1, _text(rng), "b"), (1, _text(rng), "c"), (2, _text(rng), "d")]
    docs = make_docs(rows, "doc_id long, text string, row string")
    stay = corpus_pipeline.near_dedup(spark, docs, "")
    assert stay.columns == docs.columns and sorted(map(repr, stay.collect())) == sorted(map(repr, docs.collect()))
    cut = corpus_pipeline.cut_passages(spark, docs, "")
    assert cut.columns == docs.columns and sorted(map(repr, cut.collect())) == sorted(map(repr, docs.collect()))
    copies = make_docs([*rows, (None, rows[0][1], "e"), (None, rows[3][1], "f"), (7, rows[1][1], "g"), (1, rows[1][1], "b")],
                       "doc_id long, text string, row string")
    left = [tuple(r) for r in corpus_pipeline.near_dedup(spark, copies, "").collect()]
    assert sorted(t for _, t, _ in left) == sorted(t for _, t, _ in rows)  # one of each group
    assert {(i, t) for i, t, _ in left} == {(i, t) for i, t, _ in rows}    # that of the smallest doc_id
    found = corpus_pipeline.cut_passages(spark, copies.drop("row"), "").collect()
    assert len(found) == 8 and sorted(r.text for r in found if r.text) == sorted(t for _, t, _ in rows)
    assert all(r.text == rows[3][1] for r in found if r.doc_id == 2)  # a row without a doc_id is the later one


def test_vectors_of_any_magnitude(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((400, 32))
    for i, j, scale in ((3, 4, 1e-200), (10, 11, 1e200), (20, 21, 5e-310), (30, 31, 1e307)):
        v[j] = (v[i] + 0.05 * v[j])
        v[j] *= scale / np.abs(v[j]).max()
    v[50] *= 1e-320
    v[61] = v[60]
    rows = [(i, w.tolist(), 1) for i, w in enumerate(v)]
    got = {r.vec_id: r for r in rpforest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    n = [np.ldexp(w, -int(np.frexp(np.abs(w).max())[1])) for w in v]
    n = np.array([w / np.linalg.norm(w) for w in n])
    links = [(i, j) for i in range(400) for j in range(i + 1, 400) if n[i] @ n[j] >= 0.93]
    assert {(3, 4), (10, 11), (20, 21), (30, 31), (60, 61)} <= set(links)
    low, count = united(range(400), links), np.bincount(np.array(links).ravel(), minlength=400)
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (count[i], low[i]) for i in range(400)}


def test_classifier_collects_a_row_for_each_chosen_document(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, _text(rng) if i % 2 else "!! | $$ " * 9) for i in range(300)] + [(1, _text(rng)) for _ in range(150)]
    labels = [(i, i % 2) for i in range(300)] + [(i, 1) for i in range(10_000, 11_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(y)))
    quality.train(docs, known, sample=120)
    quality.train(docs, known, sample=20_000)
    learned = sum(r.held_out is False for r in spark.range(300).withColumnRenamed("id", "doc_id").select(quality.held_out().alias("held_out")).collect())
    assert seen == [120, learned]  # labels of documents that are not there take no place, repeated rows none either


def _plain_score(model, x):
    """A row's walk through the trees, node by node."""
    total = model.base
    for feature, cut, value in zip(model.feature, model.cut, model.value):
        at, inner = 0, len(feature)
        while at < inner:
            at = 2 * at + 1 + (x[feature[at]] > cut[at])
        total += value[at - inner]
    return 1 / (1 + np.exp(-total))


def test_scores_equal_a_plain_walk(spark):
    rng = random.Random(8)
    rows = [(i, _text(rng, rng.randrange(3, 60)) if i % 3 else "A! " * rng.randrange(1, 40)) for i in range(400)] + [(900, ""), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)], "doc_id long, quality int"))
    assert len(model.feature) == quality.TREES
    got = {r.doc_id: r.score for r in quality.scores(docs, model).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(_plain_score(model, quality.statistics((t or "").encode())), abs=1e-12)


def test_fit_follows_the_histograms():
    """The first tree's first cut is the one of largest gain over all features and bins, by a plain search."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, len(quality.NAMES)))
    y = (x[:, 7] + 0.3 * rng.standard_normal(500) > 0.4).astype(float)
    model = quality.fit(x, y)
    p = y.mean()
    grad, hess = p - y, np.full(500, p * (1 - p))
    gain = {}
    for j in range(x.shape[1]):
        for c in np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality.BINS + 1)[1:-1])):
            left = x[:, j] <= c
            if min(left.sum(), (~left).sum()) >= quality.LEAF:
                gain[j, c] = sum(grad[s].sum() ** 2 / (hess[s].sum() + quality.PENALTY) for s in (left, ~left))
    best = max(gain, key=gain.get)
    assert model.feature[0][0] == best[0] == 7 and model.cut[0][0] == pytest.approx(best[1], abs=0.15)
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.95


def test_groups_of_identical_pieces_are_split(spark, monkeypatch):
    pieces = spark.range(18_000).select(F.when(F.col("id") < 12_000, 5).otherwise(F.col("id")).alias("doc_id"),
                                        F.when(F.col("id") < 12_000, 3).otherwise(F.col("id") % 60 + 1).alias("length"), F.lit("x").alias("settled"),
                                        F.lit(1).alias("offset"))
    sizes = []
    plain = packing.written

    def watched(df, name):
        out = plain(df, name)
        if name == "pack-0":
            sizes.extend(r["count"] for r in out.groupBy(F.shiftright("sequence_id", 24)).count().collect())
        return out
    monkeypatch.setattr(packing, "written", watched)
    got = packing.pack(common.written(pieces, "pieces"), capacity=64, group_pieces=1000)
    assert max(sizes) < 1200 and len(sizes) == 18 and got.count() == 18_000
    assert got.columns == ["doc_id", "length", "settled", "sequence_id", "offset", "certified"]
    fill = got.groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.max(F.col("offset") + F.col("length")).alias("end")).where("fill <> end OR fill > 64")
    assert fill.count() == 0


def test_slices_split_a_repeated_doc_id_and_long_texts(spark, make_docs):
    rng = random.Random(6)
    rows = [(5, _text(rng, 5)) for _ in range(600)] + [(100 + i, _text(rng, 5)) for i in range(1200)]
    held = Slices(make_docs(rows), docs_per_slice=100).table().groupBy("slice").count().collect()
    assert len(held) == 18 and max(r["count"] for r in held) < 170
    long = [(i, "word " * 20_000) for i in range(60)]
    size = Slices(make_docs(long), bytes_per_slice=400_000).table().groupBy("slice").agg(F.sum(F.length("text")).alias("n")).collect()
    assert len(size) > 8 and max(r.n for r in size) <= 1_500_000


def test_repeats_across_slices_of_one_doc_id(spark, make_docs, monkeypatch):
    """One doc_id on a third of all rows: passages are kept once, whatever slices its rows fall to."""
    for module in (anchors, suffixes):
        monkeypatch.setattr(module, "Slices", functools.partial(Slices, docs_per_slice=20))
    rng = random.Random(7)
    passage, own = _text(rng, 30), lambda i, n: " ".join(f"own{i}-{k}" for k in range(n))
    rows = [(9, f"{own(i, 12)} {passage} {own(-i, 12)}") for i in range(60)] + [(20 + i, own(1000 + i, 40)) for i in range(120)]
    docs = make_docs(rows).repartition(6)
    got = anchors.dedup(docs).collect()
    lost = sorted(r.n_removed for r in got if r.doc_id == 9)
    assert lost[0] == 0 and lost[1:] == [30] * 59 and not any(r.n_removed for r in got if r.doc_id != 9)
    want = sorted((n, sum_) for n, sum_, _ in word_dedup([t for _, t in sorted(rows)]))
    assert sorted((r.n_words, r.n_removed) for r in got) == want
    found = suffixes.dedup(docs, 64).collect()
    plain = byte_dedup([t for _, t in rows], 64)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == sorted(plain)


def test_only_own_tables_are_dropped(spark, make_docs):
    spark.sql("DROP TABLE IF EXISTS llm_slices_foreign")
    spark.range(3).write.saveAsTable("llm_slices_foreign")
    try:
        name = Slices(make_docs([(1, "a")])).name
        assert spark.catalog.tableExists(name)
        common.clean_scratch(spark)
        assert not spark.catalog.tableExists(name) and spark.table("llm_slices_foreign").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS llm_slices_foreign")


def test_pairs_of_blocks_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-200, 200, 16)]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    found = topk.top_k(df, df.where("vec_id % 50 = 0"), 5)
    m = np.array([r[1] for r in rows])
    for q in range(0, 900, 50):
        score = m @ m[q]
        order = [i for i in np.lexsort((np.arange(900), -score)) if i != q][:5]
        got = sorted((r["rank"], r.vec_id, r.score) for r in found.where(F.col("query_id") == q).collect()) if q in (0, 450) else None
        assert got is None or got == [(k + 1, i, int(score[i])) for k, i in enumerate(order)]
    met = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in met


@pytest.mark.parametrize("many", [3, 5])
def test_any_number_of_pivots_finds_all(spark, monkeypatch, many):
    monkeypatch.setattr(simhash, "PIVOTS", (many, many))
    monkeypatch.setattr(simhash, "TREE_SIZE", 16)
    rng = np.random.default_rng(9)
    seeds = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds, *[seeds ^ np.uint64(1 << int(rng.integers(64))) for _ in range(4)],
                                    seeds ^ np.uint64(3), seeds ^ np.uint64(7)])).view(np.int64)
    nodes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp long, node long")
    got = united(range(len(fps)), [tuple(r) for r in simhash.near_links(nodes, 2).collect()])
    u = fps.view(np.uint64)
    assert got == united(range(len(fps)), [(i, j) for i in range(len(u)) for j in range(i) if int(u[i] ^ u[j]).bit_count() <= 2])
    assert [simhash.pivots_for(n) for n in (0, 10 ** 6, 10 ** 12)] == [many] * 3
