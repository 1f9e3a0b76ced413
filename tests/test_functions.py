"""Column functions against golden vectors (projections, codec, NDVI, labels, ids)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cropcube.functions import codec, geo
from cropcube.functions.indices import ndvi, ndvi_percent
from cropcube.functions.labels import argmax, crop_label, one_hot
from cropcube.operators.evaluate import prediction_date
from cropcube.operators.scenes import scene_keys

# Five labelled points: lon/lat and their EPSG:5070 cell corner (30 m grid).
GOLDEN = [
    (-90.5923870410212, 35.57624322094004, 485550, 1405110),
    (-90.57506989498134, 35.575181872687295, 487110, 1405080),
    (-90.55773411916678, 35.57438554009128, 488670, 1405080),
    (-90.57745082006127, 35.56052757960141, 486990, 1403430),
    (-90.58575725883986, 35.57540310857804, 486150, 1405050),
]


def test_albers_forward_and_inverse(spark):
    df = spark.createDataFrame(GOLDEN, "lon DOUBLE, lat DOUBLE, x LONG, y LONG")
    fwd = geo.lonlat_to_albers("lon", "lat")
    inv = geo.albers_to_lonlat("x", "y")
    rows = df.select("*", fwd.alias("f"), inv.alias("i")).collect()
    for r in rows:
        assert abs(r.f.x - r.x) < 1e-3 and abs(r.f.y - r.y) < 1e-3
        assert abs(r.i.lon - r.lon) < 1e-9 and abs(r.i.lat - r.lat) < 1e-9


def test_albers_origin_and_utm(spark):
    r = spark.range(1).select(geo.albers_to_lonlat(F.lit(0.0), F.lit(0.0)).alias("o"),
                              geo.lonlat_to_utm(F.lit(-93.0), F.lit(45.0)).alias("u")).first()
    assert abs(r.o.lon + 96.0) < 1e-9 and abs(r.o.lat - 23.0) < 1e-9
    assert r.u.zone == 15 and abs(r.u.x - 500000.0) < 1e-3 and abs(r.u.y - 4982950.400) < 1e-3


def test_bbox_parse_and_envelope(spark):
    r = spark.range(1).select(geo.parse_bbox(F.lit("484932, 1401912, 489035, 1405125")).alias("b")).select(
        "b", geo.bbox_to_lonlat(F.col("b"), "corners").alias("c"), geo.bbox_to_lonlat(F.col("b")).alias("e")).first()
    assert tuple(r.b) == (484932, 1401912, 489035, 1405125)
    assert abs(r.c.min_lon + 90.60127609728542) < 1e-9 and abs(r.c.max_lat - 35.57460017468627) < 1e-9
    # the envelope contains golden point 1, the two-corner box does not
    assert r.e.max_lat >= 35.57624322094004 > r.c.max_lat


def test_codec_vectors(spark):
    df = spark.createDataFrame([([0, 1, 2, 10, 65535, 300], [dt.date(2021, 1, 1), dt.date(2021, 3, 2)])],
                               "v ARRAY<INT>, d ARRAY<DATE>")
    r = df.select(F.hex(codec.pack_uint("v", 2)).alias("h"), F.hex(codec.pack_dates("d")).alias("hd"),
                  codec.unpack_uint(codec.pack_uint("v", 2), 2).alias("back"),
                  codec.unpack_dates(codec.pack_dates("d")).alias("dback"),
                  F.hex(codec.pack_uint(F.array(F.lit(4), F.lit(255)), 1)).alias("u8")).first()
    assert r.h == "00000001 0002000A FFFF012C".replace(" ", "")
    assert r.hd == "48C44900"
    assert r.back == [0, 1, 2, 10, 65535, 300]
    assert r.dback == [dt.date(2021, 1, 1), dt.date(2021, 3, 2)]
    assert r.u8 == "04FF"


def test_codec_empty_and_out_of_range(spark):
    r = spark.range(1).select(codec.unpack_uint(F.lit(b"").cast("binary"), 2).alias("e")).first()
    assert r.e == []
    with pytest.raises(Exception):
        spark.range(1).select(codec.pack_uint(F.array(F.lit(-5)), 2)).collect()
    with pytest.raises(Exception):
        spark.range(1).select(codec.pack_uint(F.array(F.lit(65536)), 2)).collect()


def test_ndvi_edges(spark):
    df = spark.createDataFrame([(0, 0), (100, 300), (300, 100), (0, 50)], "red INT, nir INT")
    rows = df.select(ndvi("red", "nir").alias("n"), ndvi_percent("red", "nir").alias("p")).collect()
    assert rows[0].n is None and rows[0].p == 0
    assert abs(rows[1].n - 0.5) < 1e-12 and rows[1].p == 50
    assert abs(rows[2].n + 0.5) < 1e-12 and rows[2].p == -50
    assert rows[3].p == 100


@pytest.mark.parametrize("cdl,scl,label", [
    ("Corn", [4, 5], 5),          # target crop, vegetation in last two -> crop label
    ("Corn", [4, 5, 5], 2),       # target, last two not vegetation -> no crop growing
    ("Peanuts", [5, 4], 1),       # other cultivated
    ("Open Water", [5, 5], 0),    # not listed
    (None, [5], 0),               # null class
    ("Cotton", [], 2),            # empty window: "none is vegetation" holds
    ("Soybeans", [0, 4, 0], 3),   # zeros (padding) ignored
])
def test_crop_label(spark, cdl, scl, label):
    df = spark.createDataFrame([(cdl, scl)], "cdl STRING, scl ARRAY<INT>")
    assert df.select(crop_label(F.col("cdl"), F.col("scl")).alias("l")).first().l == label


def test_one_hot_argmax_prediction_date(spark):
    r = spark.range(1).select(one_hot(F.lit(3)).alias("o"), argmax(F.array(F.lit(1), F.lit(5), F.lit(5))).alias("a"),
                              prediction_date(F.lit(2019), F.lit(0)).alias("d")).first()
    assert r.o == [0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0]
    assert r.a == 1
    assert r.d == dt.date(2019, 4, 30)


def test_scene_keys(spark):
    df = spark.createDataFrame([("S2A_15SYU_20190101_1_L2A", "2019-01-01T16:45:00Z")], "scene_id STRING, datetime STRING")
    r = scene_keys(df).first()
    assert (r.base_id, r.seq, r.tile, r.mgrs, r.scene_date) == ("S2A_15SYU_20190101", 1, "15SYU_1", "15SYU", dt.date(2019, 1, 1))
