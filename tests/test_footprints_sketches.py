"""Convex footprints against brute force, quantile sketches against exact ranks, and the crop."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions import geo
from cropcube.operators import raster as R
from cropcube.operators import scenes as SC
from cropcube.operators import sketches as SK

RING = "array<struct<x:double,y:double>>"


def _turned(rng, cx, cy, way=1):
    """A rectangle turned by a random angle, its corners in order."""
    a, w, h = rng.uniform(0, math.pi), rng.uniform(0.1, 1.5), rng.uniform(0.1, 1.5)
    corners = [(-w, -h), (w, -h), (w, h), (-w, h)][::way]
    return [(cx + x * math.cos(a) - y * math.sin(a), cy + x * math.sin(a) + y * math.cos(a)) for x, y in corners]


def _cross(o, a, b):
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def _inside(p, ring):
    side = [_cross(ring[i], ring[(i + 1) % 4], p) for i in range(4)]
    return all(s >= 0 for s in side) or all(s <= 0 for s in side)


def _meet(a, b):
    """A corner of one inside the other, or two edges that cross."""
    if any(_inside(p, b) for p in a) or any(_inside(p, a) for p in b):
        return True
    for i in range(4):
        for j in range(4):
            p, q, r, s = a[i], a[(i + 1) % 4], b[j], b[(j + 1) % 4]
            if _cross(p, q, r) * _cross(p, q, s) < 0 and _cross(r, s, p) * _cross(r, s, q) < 0:
                return True
    return False


def test_separating_axes_against_corners_and_edges(spark):
    rng = random.Random(9)
    pairs = [(_turned(rng, 0, 0, rng.choice([1, -1])), _turned(rng, rng.uniform(-2, 2), rng.uniform(-2, 2), rng.choice([1, -1]))) for _ in range(400)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], f"i int, a {RING}, b {RING}")
    got = dict(df.select("i", geo.convex_intersect("a", "b")).collect())
    want = {i: _meet(a, b) for i, (a, b) in enumerate(pairs)}
    assert got == want and 50 < sum(want.values()) < 350
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    touching = [[(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)], [(1.0, 0.2), (2.0, 0.2), (2.0, 0.4), (1.0, 0.4)],
                [(1.01, 1.0), (2.0, 1.0), (2.0, 2.0), (1.01, 2.0)]]
    one = spark.createDataFrame([(i, square, t) for i, t in enumerate(touching)], f"i int, a {RING}, b {RING}")
    assert dict(one.select("i", geo.convex_intersect("a", "b")).collect()) == {0: True, 1: True, 2: False}


def test_footprint_search_against_all_pairs(spark):
    rng = random.Random(4)
    scenes = [(f"S2A_T_{i}", "sentinel-2-l2a" if i % 9 else "other", f"199{7 + i % 2}-03-04T16:45:00Z", _turned(rng, rng.uniform(-94, -90), rng.uniform(33, 37)))
              for i in range(150)]
    areas = [(f"a{i}", 1997 + i % 2, _turned(rng, rng.uniform(-94, -90), rng.uniform(33, 37))) for i in range(20)]
    got = SC.search_footprints(spark.createDataFrame(scenes, f"scene_id string, collection string, datetime string, footprint {RING}"),
                               spark.createDataFrame(areas, f"bbox string, year int, area {RING}"))
    pairs = [(r.scene_id, r.bbox) for r in got.collect()]
    want = {(s[0], a[0]) for s in scenes for a in areas if s[1] == "sentinel-2-l2a" and int(s[2][:4]) == a[1] and _meet(s[3], a[2])}
    assert sorted(pairs) == sorted(want) and want
    boxes = {(s[0], a[0]) for s in scenes for a in areas if s[1] == "sentinel-2-l2a" and int(s[2][:4]) == a[1]
             and all(min(p[k] for p in s[3]) <= max(p[k] for p in a[2]) and min(p[k] for p in a[2]) <= max(p[k] for p in s[3]) for k in (0, 1))}
    assert want < boxes  # the boxes alone give pairs that do not meet


def test_area_rings_keep_their_corners(spark):
    ring = SC.aoi_rings(spark, years=(1999,)).select("bbox", "area", geo.ring_bounds("area").alias("b")).collect()
    env = {r.bbox: r for r in SC.aoi_frame(spark, years=(1999,)).collect()}
    for r in ring:
        assert len({tuple(p) for p in r.area}) == 4
        assert tuple(r.b) == tuple(env[r.bbox][c] for c in ("a_min_lon", "a_min_lat", "a_max_lon", "a_max_lat"))


@pytest.mark.parametrize("shape", ["uniform", "skewed", "few"])
def test_sketch_ranks(spark, shape):
    rng = random.Random(shape)
    draw = {"uniform": lambda: rng.randrange(1, 10_000), "skewed": lambda: int(10_000 ** rng.random()) or 1, "few": lambda: rng.choice([1, 2, 2, 900])}[shape]
    rows = [("a" if i % 3 else "b", i % 4, [draw() if i % 17 else 0, *[draw()] * 11]) for i in range(40_000)]
    df = spark.createDataFrame([(b, y, *v) for b, y, v in rows], "bbox string, year int, " + ", ".join(f"{b} int" for b in K.BANDS))
    at = [0.01, 0.1, 0.5, 0.9, 0.99]
    kept = SK.band_sketches(df.repartition(6))
    assert kept.count() == 8 * 12 and kept.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    merged = SK.quantiles(SK.merge_sketches(kept), at).where("band = 'coastal'").collect()
    values = sorted(v[0] for _, _, v in rows if v[0])
    for r in merged:
        below, upto = sum(v < r.value for v in values) / len(values), sum(v <= r.value for v in values) / len(values)
        assert r.n == len(values) and below - SK.RANK_ERROR <= r["rank"] <= upto + SK.RANK_ERROR
    years = SK.quantiles(SK.merge_sketches(kept, by=("year",)), [0.5], by=("year",)).where("band = 'blue'").collect()
    assert {r.year: r.n for r in years} == {y: 10_000 for y in range(4)}
    assert SK.quantiles(SK.merge_sketches(SK.band_sketches(df.where("false")))).collect() == []


def test_crop_at_its_own_size(spark):
    cells = spark.createDataFrame([(r, c) for r in (0, 799, 800, 5000) for c in (0, 17, 799, 800)], "row int, col int")
    assert {tuple(r) for r in R.crop_grid(cells).collect()} == {(r, c) for r in (0, 799) for c in (0, 17, 799)}
    assert {tuple(r) for r in R.crop_grid(cells, 800, 18).collect()} == {(r, c) for r in (0, 799) for c in (0, 17)}
