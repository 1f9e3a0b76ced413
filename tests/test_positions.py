"""Positions without a global sort: permutation, interleave and exact batches."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cropcube.operators import positions as P


def _draw(seed, epoch, *key):
    return int(hashlib.md5("|".join(map(str, [seed, epoch, "shuffle", *key])).encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("bucket_rows", [50_000, 37])
def test_permutation(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(P, "BUCKET_ROWS", bucket_rows)
    rows = [(i, 1990 + i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "pixel_id long, year int").repartition(7)
    for epoch in (0, 1):
        got = {(r.pixel_id, r.year): r.position for r in P.shuffled(df, seed=3, epoch=epoch).collect()}
        order = sorted(rows, key=lambda r: (_draw(3, epoch, *r), r))
        assert got == {r: i for i, r in enumerate(order)}
    assert P.shuffled(df.where("false")).collect() == []


@pytest.mark.parametrize("bucket_rows", [50_000, 20])
def test_interleave(spark, tmp_path, monkeypatch, bucket_rows):
    monkeypatch.setattr(P, "BUCKET_ROWS", bucket_rows)
    sizes = [7, 1, 40, 23, 3]
    for f, n in enumerate(sizes):
        spark.createDataFrame([(f, i) for i in range(n)], "f int, i int").coalesce(1).write.parquet(str(tmp_path / f"d/part={f}"))
    got = P.interleaved(spark.read.parquet(str(tmp_path / "d"))).select("f", "i", "position").collect()
    order = sorted((i, f) for f, n in enumerate(sizes) for i in range(n))
    assert {(r.i, r.f): r.position for r in got} == {x: k for k, x in enumerate(order)}


@pytest.mark.parametrize("partitions", [1, 9])
def test_batches_are_exact_on_any_partitions(spark, tmp_path, partitions):
    path, size = str(tmp_path / "rows"), 128
    rng = random.Random(2)
    df = spark.createDataFrame([(i, rng.randrange(7)) for i in range(1000)], "i int, label int")
    df.repartition(partitions).write.parquet(path)
    (tmp_path / "none").mkdir()
    spark.createDataFrame([], "i int, label int").coalesce(1).write.mode("append").parquet(path)  # a file without rows
    b = P.Batches(spark, path, size)
    rows = b.rows().collect()
    assert sorted((r.batch, r.place) for r in rows) == [divmod(n, size) for n in range(1000)] and {r.i for r in rows} == set(range(1000))
    whole = {r.batch: (r.i, r.label) for r in b.stacked("i", "label").collect()}
    assert {k: len(i) for k, (i, _) in whole.items()} == {k: min(size, 1000 - size * k) for k in range(8)}
    label = {r.i: r.label for r in rows}
    for k in (0, 3, 7):  # a consumer that reads batch by batch gets the same rows in the same order
        assert [r.i for r in b.read(k).collect()] == whole[k][0]
        assert [label[i] for i in whole[k][0]] == whole[k][1]
    assert b.read(8).collect() == []


def test_reading_a_batch_opens_its_files_only(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(10).write.parquet(path)
    b = P.Batches(spark, path, 100)
    sizes = {r.file: (r.before, r.n) for r in b.files.collect()}
    reached = [f for f, (before, n) in sizes.items() if before < 300 and before + n > 200]
    assert len(b.read(2).inputFiles()) == len(reached) < 4


def test_numbering_needs_no_sort(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5000).repartition(4).write.parquet(path)
    plan = P.Batches(spark, path).rows()._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("_row"):]
    assert "BroadcastExchange" in plan and "Sort [id" not in scan and "rangepartitioning" not in plan


def test_positions_by_bucket(spark):
    df = spark.createDataFrame([(b, v) for b in (5, -1, 9) for v in range(b + 4)], "b int, v int")
    got = P.positions(df, F.col("b"), ["v"]).collect()
    assert sorted((r.position, r.b, r.v) for r in got) == [(i, *x) for i, x in enumerate(sorted((b, v) for b in (5, -1, 9) for v in range(b + 4)))]
