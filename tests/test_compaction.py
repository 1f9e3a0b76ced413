"""Compaction: the same rows before, during and after; a crash between steps loses nothing."""

import os

import pytest
from pyspark.sql import functions as F

from cropcube.plans.stream_queries import landing_rows
from cropcube.streaming import compaction as CP
from cropcube.streaming import ingest as I


@pytest.fixture()
def sink(spark, sf_small, tmp_path):
    """Four epochs: three shares of some rows, then corrections of the first."""
    base = str(tmp_path / "rows")
    landing_rows(spark, sf_small).where("year IN (1996, 1997)").dropDuplicates(I.OBSERVATION_KEY).write.parquet(base)
    rows, path = spark.read.parquet(base), str(tmp_path / "sink")
    for epoch in range(3):
        I.land_batch(rows.where(F.pmod("pixel_id", F.lit(3)) == epoch), epoch, path)
    I.land_batch(rows.where("pixel_id % 3 = 0 AND year = 1996").withColumn("red", F.lit(20_000)), 3, path)
    return path, rows


def _rows(spark, sink, schema):
    return sorted(map(tuple, I.landed(spark, sink, schema).collect()))


def _epochs(sink):
    return {d.rsplit("epoch=", 1)[1] for d, _, f in os.walk(sink) if "epoch=" in d and any(x.endswith(".parquet") for x in f)}


def test_same_rows_at_every_step(spark, sink):
    path, rows = sink
    want = _rows(spark, path, rows.schema)
    assert sum(r[rows.columns.index("red")] == 20_000 for r in want) == rows.where("pixel_id % 3 = 0 AND year = 1996").count() > 0
    entries = CP.fold(spark, path, rows.schema, I.OBSERVATION_KEY, 1)
    assert _rows(spark, path, rows.schema) == want  # a crash here leaves an unnamed generation
    before = CP.manifest(spark, path).count()
    CP.publish(spark, path, entries)
    assert before == 0 and CP.manifest(spark, path).count() == entries.count() > 0
    assert _rows(spark, path, rows.schema) == want  # and here, dead epochs
    assert _epochs(path) == {"0", "1", "2", "3"}
    assert CP.vacuum(spark, path) > 0 and _epochs(path) == {"2", "3"}
    assert _rows(spark, path, rows.schema) == want
    assert CP.compact(spark, path, rows.schema, I.OBSERVATION_KEY) == 2  # all but the latest epoch
    assert _rows(spark, path, rows.schema) == want
    CP.vacuum(spark, path)
    assert _epochs(path) == {"3"} and _rows(spark, path, rows.schema) == want
    assert CP.dead_folders(spark, path).count() == 0 and CP.compact(spark, path, rows.schema, I.OBSERVATION_KEY) is None


def test_an_unfinished_version_is_not_in_force(spark, sink):
    path, rows = sink
    want = _rows(spark, path, rows.schema)
    entries = CP.fold(spark, path, rows.schema, I.OBSERVATION_KEY, 2)
    CP.publish(spark, path, entries)
    os.makedirs(f"{path}/_manifest/version=2")  # a writer that died
    assert CP._versions(spark, path) == [1] and _rows(spark, path, rows.schema) == want
    again = CP.fold(spark, path, rows.schema, I.OBSERVATION_KEY, 2)
    assert again.isEmpty()
    I.land_batch(rows.where("pixel_id % 3 = 2").withColumn("red", F.lit(30_000)), 4, path)
    want = _rows(spark, path, rows.schema)
    assert CP.compact(spark, path, rows.schema, I.OBSERVATION_KEY) == 2
    assert _rows(spark, path, rows.schema) == want


def test_ingest_goes_on_after_compaction(spark, sink):
    path, rows = sink
    want = _rows(spark, path, rows.schema)
    CP.compact(spark, path, rows.schema, I.OBSERVATION_KEY)
    CP.vacuum(spark, path)
    # the latest epoch replayed, and rows that were folded delivered again
    I.land_batch(rows.where("pixel_id % 3 = 0 AND year = 1996").withColumn("red", F.lit(20_000)), 3, path)
    I.land_batch(rows.where("pixel_id % 3 = 1"), 4, path)
    assert _rows(spark, path, rows.schema) == want and _epochs(path) == {"3"}


def test_touched_partitions_only(spark, sink):
    path, rows = sink
    want = _rows(spark, path, rows.schema)
    one = rows.where("year = 1997").select("bbox", "year").distinct().orderBy("bbox").limit(1)
    CP.compact(spark, path, rows.schema, I.OBSERVATION_KEY, touched=one)
    assert CP.manifest(spark, path).count() == 1 and _rows(spark, path, rows.schema) == want
    CP.compact(spark, path, rows.schema, I.OBSERVATION_KEY)
    assert CP.manifest(spark, path).count() == rows.select("bbox", "year").distinct().count()
    assert _rows(spark, path, rows.schema) == want


def test_empty_batch_reads_nothing(spark, sink, tmp_path, monkeypatch):
    path, rows = sink
    monkeypatch.setattr(I, "live_rows", lambda *a: pytest.fail("read for an empty batch"))
    I.land_batch(rows.where("false"), 9, path)
    I.refresh_series_batch(path, str(tmp_path / "series"))(rows.where("false"), 9)
    assert not os.path.exists(tmp_path / "series")


def test_many_partitions_are_joined(spark, sink, monkeypatch):
    path, rows = sink
    some = rows.where("pixel_id % 7 IN (1, 2) AND year = 1997")
    named = I.landed(spark, path, rows.schema, I.touched_partitions(some))
    monkeypatch.setattr(I, "NAMED_PARTITIONS", 1)
    touched = I.touched_partitions(some)
    assert touched.where is None and not touched.none
    joined = I.landed(spark, path, rows.schema, touched)
    assert sorted(map(tuple, named.collect())) == sorted(map(tuple, joined.collect())) and joined.select("bbox", "year").distinct().count() == 2


SMALL = "bbox string, year int, pixel_id long, tile string, scene_date date, red int"


@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories(spark, tmp_path, seed):
    """Deliveries, replays, compactions, crashes and vacuums in any order give the rows that a dictionary gives."""
    import datetime as dt
    import random
    rng = random.Random(seed)
    path, held, epoch, last = str(tmp_path / "sink"), {}, 0, []
    schema = spark.createDataFrame([], SMALL).schema

    def delivery():
        rows = {}
        for _ in range(rng.randrange(1, 12)):
            key = (rng.choice("ab"), rng.choice([1, 2]), rng.randrange(4), "t", dt.date(2000, 1, rng.randrange(1, 4)))
            rows[key] = rng.randrange(3)
        return [(*k, v) for k, v in rows.items()]

    for step in ["land", "land", *rng.choices(["land", "replay", "compact", "fold", "vacuum", "half"], k=9), "compact", "land"]:
        if step == "land":
            last = delivery()
            I.land_batch(spark.createDataFrame(last, SMALL), epoch, path)
            held.update({r[:5]: r for r in last})
            epoch += 1
        elif step == "replay":
            I.land_batch(spark.createDataFrame(last, SMALL), epoch - 1, path)
        elif step == "compact":
            CP.compact(spark, path, schema, I.OBSERVATION_KEY, through=rng.randrange(epoch))
        elif step == "fold":  # a crash after the folding
            CP.fold(spark, path, schema, I.OBSERVATION_KEY, epoch - 2)
        elif step == "half":  # a crash while a version was written
            os.makedirs(f"{path}/_manifest/version={(CP._versions(spark, path) or [0])[-1] + 1}", exist_ok=True)
        else:
            CP.vacuum(spark, path)
        assert _rows(spark, path, schema) == sorted(held.values()), step
