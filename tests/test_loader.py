"""Bucketing edge cases of the loader on literal series."""

import datetime as dt

from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.operators import loader as L
from cropcube.operators import series as S
from cropcube.operators.series import build_series


def _series(spark, days, cdl="Corn", scl=4):
    d0 = dt.date(2020, 1, 1)
    rows = [("b", 2020, 1, cdl, d0 + dt.timedelta(days=d), f"T_{i}", scl, *([100 + i] * 3), 200, *([300] * 3), 900, *([5] * 4))
            for i, d in enumerate(days)]
    cols = "bbox STRING, year INT, pixel_id LONG, CDL STRING, scene_date DATE, tile STRING, scl INT, " + \
           ", ".join(f"{b} INT" for b in K.BANDS)
    return build_series(spark.createDataFrame(rows, cols))


def _sweep_slots(spark, days, start):
    ex = L.sweep_examples(_series(spark, days), start_days=(start,))
    return ex.select("slots", "label").first()


def test_empty_window_gives_zero_slot(spark):
    r = _sweep_slots(spark, [0, 1], 100)
    assert len(r.slots) == 1 and r.slots[0].slot == 0 and r.slots[0].bands == [0] * 12
    assert r.label == 2  # crop class, no vegetation seen


def test_one_image_and_shared_bucket(spark):
    r = _sweep_slots(spark, [10], 0)
    assert [s.slot for s in r.slots] == [0]
    r = _sweep_slots(spark, [10, 12, 16], 0)   # 10 and 12 share slot 0; first wins
    assert [(s.slot, s.day) for s in r.slots] == [(0, 0), (1, 6)]


def test_day_120_goes_to_last_slot(spark):
    r = _sweep_slots(spark, [0, 120, 121], 0)
    assert [(s.slot, s.day) for s in r.slots] == [(0, 0), (24, 120)]
    assert len(r.slots) <= K.MAX_IMAGES_PER_SERIES


def test_subsample_caps_at_25_in_date_order(spark):
    days = list(range(0, 120, 2))  # 60 images in the window
    ex = L.training_examples(_series(spark, days))
    r = ex.first()
    slots = [s.slot for s in r.slots]
    assert len(slots) <= 25 and slots == sorted(slots) and len(set(slots)) == len(slots)


def test_window_starts_are_uniform_and_redrawn(spark):
    """Every range has all its starts, about equally often; seeds and epochs differ; any key works."""
    keys = spark.range(20_000).select(F.lit("b").alias("bbox"), F.lit(2020).alias("year"), F.col("id").alias("pixel_id"),
                                      F.lit("Corn").alias("CDL"))
    key = ("bbox", "year", "pixel_id", "CDL")
    rows = keys.select(L.start_draw(key).alias("a"), L.start_draw(key, seed=1).alias("b"),
                       L.start_draw(key, epoch=1).alias("c")).toPandas()
    for n in range(200, 246):
        hits = (rows.a % n).value_counts()
        assert len(hits) == n and hits.min() > 20_000 / n / 2 and hits.max() < 20_000 / n * 2
    assert (rows.a == rows.b).mean() < 0.001 and (rows.a == rows.c).mean() < 0.001
    edge = spark.createDataFrame([("b", 2020, k, "Corn") for k in (2 ** 63 - 1, -2 ** 63, 10 ** 10, -1)],
                                 "bbox STRING, year INT, pixel_id LONG, CDL STRING")
    assert all(0 <= r[0] < 2 ** 32 for r in edge.select(L.start_draw(key)).collect())


def test_epoch_redraws_images_whatever_their_values(spark):
    days = list(range(0, 120, 2))
    ser = _series(spark, days)
    one, two = (L.training_examples(ser, epoch=e).first().slots for e in (0, 1))
    assert [s.day for s in one] != [s.day for s in two]
    brighter = ser.withColumn("images", F.transform("images", lambda i: i.withField(
        "bands", F.transform(i["bands"], lambda b: b + 7))))
    assert [s.day for s in L.training_examples(brighter).first().slots] == [s.day for s in one]


def test_slot_count_follows_the_window():
    assert [L.slot_count(), L.slot_count(60), L.slot_count(240), L.slot_count(400)] == [25, 13, 49, 74]


def test_dense_and_features_shape(spark):
    ex = L.sweep_examples(_series(spark, [0, 7, 30]), start_days=(0,))
    r = ex.select(L.dense_slots(F.col("slots")).alias("d"), L.features(F.col("slots")).alias("f")).first()
    assert len(r.d) == 25 and all(len(x) == 15 for x in r.d)
    assert len(r.f) == 300
    assert r.f[12 * 24] == 0.0  # padded slot stays zero after normalisation
    # a longer window keeps its late slots
    late = L.bucketize(L.day_window(S.series_rows("images"), F.lit(0), 240))
    d = _series(spark, [0, 200]).select(L.dense_slots(late, 240).alias("d")).first().d
    assert len(d) == 49 and d[40][-1] == 200


def test_dense_slots_build_their_lookup_once(spark):
    """The lookup of the slots is made once a row, not for each slot and each field taken from it."""
    d = L.sweep_examples(_series(spark, [0, 3, 7, 60])).select("start_day", L.dense_slots(F.col("slots")).alias("d"), "slots")
    assert d._jdf.queryExecution().analyzed().toString().count("map_from_entries(") == 1
    for r in d.collect():
        want = {s.slot: [*s.bands, s.ndvi, s.scl, s.day] for s in r.slots}
        assert r.d == [want.get(i, [0] * 15) for i in range(25)]
