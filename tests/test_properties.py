"""Property tests: codec round trip, slot invariants, sample inside grid, disjoint splits."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions import codec
from cropcube.operators import loader as L
from cropcube.operators import raster as R
from cropcube.operators.series import build_series, decode_series, encode_series
from cropcube.sources import fixtures as FX

u16_lists = st.lists(st.integers(0, 65535), min_size=0, max_size=40)


@settings(max_examples=5, deadline=None)
@given(st.lists(u16_lists, min_size=1, max_size=20), st.lists(st.integers(0, 255), max_size=30))
def test_codec_round_trip(spark, batch, u8):
    df = spark.createDataFrame([(v, u8) for v in batch], "v ARRAY<INT>, s ARRAY<INT>")
    rows = df.select("v", codec.unpack_uint(codec.pack_uint("v", 2), 2).alias("b"),
                     "s", codec.unpack_uint(codec.pack_uint("s", 1), 1).alias("sb")).collect()
    for r in rows:
        assert r.b == r.v and r.sb == r.s


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 364), min_size=1, max_size=80, unique=True), st.integers(0, 250))
def test_slots_invariants(spark, days, start):
    d0 = dt.date(2020, 1, 1)
    days = sorted(days)
    rows = [("b", 2020, 7, "Rice", d0 + dt.timedelta(days=d), f"T_{i}", 4 if i % 3 else 5, *[(d * 7 + j) % 9000 + 1 for j in range(12)])
            for i, d in enumerate(days)]
    cols = "bbox STRING, year INT, pixel_id LONG, CDL STRING, scene_date DATE, tile STRING, scl INT, " + \
           ", ".join(f"{b} INT" for b in K.BANDS)
    ser = build_series(spark.createDataFrame(rows, cols))
    # encode -> decode is lossless on whole series
    back = decode_series(encode_series(ser)).select("images").first().images
    assert back == ser.select("images").first().images
    for ex in (L.sweep_examples(ser, start_days=(start,)), L.training_examples(ser, drop_double_crops=False)):
        r = ex.first()
        slots = [s.slot for s in r.slots]
        assert 1 <= len(slots) <= K.MAX_IMAGES_PER_SERIES
        assert slots == sorted(slots) and len(set(slots)) == len(slots)
        assert all(0 <= s < K.MAX_IMAGES_PER_SERIES for s in slots)
        assert r.label in range(K.NUM_CLASSES)


def test_samples_inside_grid_and_splits_disjoint(spark, sf_small):
    strips = FX.raster_strips(spark, sf_small)
    for stride in (1, 3, 15):
        smp = R.grid_sample(strips, stride, start=R.seeded_start(F.col("raster_id"), stride))
        assert R.samples_outside_grid(strips, smp).count() == 0
    from cropcube.plans.catalog import series
    outside = smp.select("raster_id", "row", (F.col("col") + 1000).alias("col"), "code")
    assert R.samples_outside_grid(strips, outside).count() == outside.count() > 0
    keys = L.split_keys(series(spark, sf_small), K.FIXTURE_SPLIT_YEARS)
    assert L.leakage(keys, ("pixel_id", "year")).count() == 0
    planted = keys.where("split = 'train'").limit(1).withColumn("split", F.lit("test"))
    assert [r.splits for r in L.leakage(keys.unionByName(planted), ("pixel_id", "year")).collect()] == [["test", "train"]]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.floats(-124.0, -67.0), st.floats(25.0, 49.0)), min_size=1, max_size=50))
def test_albers_round_trip(spark, points):
    from cropcube.functions import geo
    df = spark.createDataFrame(points, "lon DOUBLE, lat DOUBLE")
    fwd = df.withColumn("p", geo.lonlat_to_albers("lon", "lat"))
    back = fwd.withColumn("q", geo.albers_to_lonlat(F.col("p.x"), F.col("p.y"))).collect()
    for r in back:
        assert abs(r.q.lon - r.lon) < 1e-9 and abs(r.q.lat - r.lat) < 1e-9
