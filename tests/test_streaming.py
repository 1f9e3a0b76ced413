"""Streaming ingest: any order of deliveries lands every observation once, and corrections win."""

import __spark_entry__ as E
from pyspark.sql import functions as F

from cropcube.plans.stream_queries import landing_rows
from cropcube.streaming import ingest as I


def test_back_fill_newest_first_loses_nothing(spark, sf_small, tmp_path):
    """Yearly files, the newest first, one a trigger."""
    rows = landing_rows(spark, sf_small).cache()
    years = sorted((r.year for r in rows.select("year").distinct().collect()), reverse=True)
    landing, sink, ckpt = (str(tmp_path / n) for n in ("landing", "sink", "ckpt"))
    for n, year in enumerate(years):
        rows.where(F.col("year") == year).coalesce(1).write.parquet(f"{landing}/{n}")
        I.ingest_available(I.observation_stream(spark, f"{landing}/*/*.parquet", rows.schema, 1), sink, ckpt)
    out = I.landed(spark, sink, rows.schema)
    assert out.count() == rows.select(*I.OBSERVATION_KEY).distinct().count()
    assert out.select("year").distinct().count() == len(years) > 5


def test_replay_and_corrected_delivery(spark, sf_small, tmp_path):
    rows = landing_rows(spark, sf_small).where("year = 1997").limit(50)
    rows.write.parquet(str(tmp_path / "rows"))
    rows, sink = spark.read.parquet(str(tmp_path / "rows")), str(tmp_path / "sink")
    n = rows.select(*I.OBSERVATION_KEY).distinct().count()

    def land(batch, epoch):
        I.land_batch(batch, epoch, sink, I.touched_partitions(batch))
        return spark.read.parquet(sink).count(), I.landed(spark, sink, rows.schema).count()
    assert land(rows, 0) == (n, n)
    assert land(rows, 0) == (n, n)      # a replayed epoch rewrites its own files
    assert land(rows, 1) == (n, n)      # a repeated delivery adds nothing
    fixed = rows.dropDuplicates(I.OBSERVATION_KEY).limit(5).withColumn("red", F.col("red") + 16_000)
    assert land(fixed, 2) == (n + 5, n)  # a correction lands, and is what readers get
    assert I.landed(spark, sink, rows.schema).where("red >= 16000").count() == 5


def test_touched_partitions_prune_the_read(spark, sf_small, tmp_path):
    rows, sink = landing_rows(spark, sf_small), str(tmp_path / "sink")
    I.land_batch(rows, 0, sink)
    where = I.touched_partitions(rows.where("year = 1996 AND pixel_id % 7 = 2"))
    plan = I.landed(spark, sink, rows.schema, where)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bbox" in plan or "PartitionFilters: [(bbox" in plan or "1996" in plan.split("PartitionFilters")[1][:400]


def test_window_counts_stream_subset_of_batch(spark, sf_small):
    s = {tuple(r) for r in E.queries()["r04_stream_window_counts"](spark, sf_small).collect()}
    b = {tuple(r) for r in E.queries()["r04_window_counts"](spark, sf_small).collect()}
    assert s and s <= b


def _delivery(spark, rows):
    return spark.createDataFrame(rows, "bbox string, year int, pixel_id long, tile string, scene_date string, scl int, blue int")


def test_landing_compares_by_key_and_single_epochs_are_not_grouped(spark, tmp_path):
    sink = str(tmp_path / "sink")
    first = [("a", 1997, 1, "t", "d1", 4, None), ("a", 1997, 2, "t", "d1", 4, 7), ("b", 1998, 1, "t", "d1", 5, 9), (None, 1997, 1, "t", "d1", 4, 1)]
    second = [first[0], ("a", 1997, 2, "t", "d1", 4, 8), ("a", 1997, 3, "t", "d1", 4, 1), first[2]]  # same, corrected, new, same
    one = _delivery(spark, first)
    I.land_batch(one, 0, sink)
    alone = I.landed(spark, sink, one.schema)
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert sorted(map(str, alone.collect())) == sorted(map(str, one.collect()))
    for _ in range(2):  # the second time a replay
        I.land_batch(_delivery(spark, second), 1, sink)
        stored = spark.read.parquet(sink).where("epoch = 1").select("pixel_id", "blue").collect()
        assert sorted(map(tuple, stored)) == [(2, 8), (3, 1)]
    got = sorted(map(str, I.landed(spark, sink, one.schema).collect()))
    assert got == sorted(map(str, _delivery(spark, [first[0], second[1], second[2], first[2], first[3]]).collect()))
