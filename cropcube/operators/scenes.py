"""Scene catalogue operators (S09, W03, F08, F12, J02, J03, J05, J12, L11, U01,
T08-T11, T38, A06, A07, A18).

The catalogue is small next to the pixel data (one row per scene), but it
still grows with time and area, so nothing here collects it: keep-latest is
an aggregate, the footprint search is a bucketed equi-join, and "what is
already done" is an anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, MapType, StringType, StructField,
                               StructType)

from cropcube import constants as K
from cropcube.functions import geo
from cropcube.functions.draws import draw

FEATURE_SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("collection", StringType()),
    StructField("bbox", ArrayType(DoubleType())),
    StructField("properties", StructType(
        [StructField("datetime", StringType())]
        + [StructField(f"s2:{n}", DoubleType()) for n in K.USABLE_AREA_PROPERTIES])),
    StructField("assets", MapType(StringType(), StructType([StructField("href", StringType())]))),
])


def parse_catalog(json_lines: DataFrame, col: str = "json") -> DataFrame:
    """S09 + T38: JSON feature text -> one typed row per scene.

    ``from_json`` with a fixed schema (no inference pass); asset hrefs are
    looked up by name from the asset map.
    """
    f = F.from_json(F.col(col), FEATURE_SCHEMA).alias("f")
    p = json_lines.select(f)
    return p.select(
        F.col("f.id").alias("scene_id"), F.col("f.collection").alias("collection"),
        F.col("f.properties.datetime").alias("datetime"),
        *[F.col("f.properties").getField(f"s2:{n}").alias(n) for n in K.USABLE_AREA_PROPERTIES],
        F.col("f.bbox")[0].alias("min_lon"), F.col("f.bbox")[1].alias("min_lat"),
        F.col("f.bbox")[2].alias("max_lon"), F.col("f.bbox")[3].alias("max_lat"),
        *[F.col("f.assets")[a]["href"].alias(f"href_{a}") for a in K.ASSETS])


def read_scene_catalog(spark, *paths: str) -> DataFrame:
    """A catalogue stored as JSON-lines pages (any number of files) -> typed scenes.

    The pages are a plain multi-file text scan (one task per file split);
    no page loop on the driver.
    """
    return parse_catalog(spark.read.text(list(paths)).withColumnRenamed("value", "json"))


def scene_keys(df: DataFrame, id_col: str = "scene_id") -> DataFrame:
    """Tile, base id, processing number, date from a scene id and datetime."""
    parts = F.split(F.col(id_col), "_")
    return df.withColumns({
        "mgrs": F.element_at(parts, 2),
        "tile": F.concat_ws("_", F.element_at(parts, 2), F.element_at(parts, -2)),
        "base_id": F.regexp_extract(F.col(id_col), r"^(.*)_[^_]*_[^_]*$", 1),
        "seq": F.element_at(parts, -2).cast("int"),
        "scene_date": F.to_date(F.substring("datetime", 1, 10)),
    })


def keep_latest(scenes: DataFrame) -> DataFrame:
    """One scene per base id, the highest processing number (then id) wins.

    One aggregate carrying the whole row (``max`` of a struct led by
    (seq, scene_id)): a single scan, combined map-side, no join back.
    """
    from cropcube.operators.observe import latest_per_key
    return latest_per_key(scenes, ["base_id"], ["seq", "scene_id"])


def usable_area(df: DataFrame) -> Column:
    """The five usable-area percentages summed (null if any is missing)."""
    total = None
    for n in K.USABLE_AREA_PROPERTIES:
        total = F.col(n) if total is None else total + F.col(n)
    return total


def usable_scenes(df: DataFrame, threshold: float = K.USABLE_AREA_THRESHOLD) -> DataFrame:
    """scenes whose usable area is strictly above the threshold (null = not usable)."""
    return df.withColumn("usable_area", usable_area(df)).where(F.col("usable_area") > F.lit(float(threshold)))


def year_range(year) -> tuple[Column, Column]:
    """First instant of the year and of the next (half-open range)."""
    y = F.col(year) if isinstance(year, str) else year
    return F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y + 1, F.lit(1), F.lit(1))


def aoi_frame(spark, bboxes=tuple(K.AOI_BBOXES), years=tuple(K.AOI_YEARS), mode: str = "envelope") -> DataFrame:
    """J02 + T01 + T02: areas x years with lon/lat bounds.

    The cross product is a generator (explode of the year list) on a small literal
    frame, not a join.  Each corner of an area is a row, so the projection stands once in the
    plan; ``mode`` as in ``geo.bbox_to_lonlat``.
    """
    rows = [(b, *xy) for b in bboxes for xy in _corners(b, mode)]
    at = geo.albers_to_lonlat("x", "y")
    corners = spark.createDataFrame(rows, "bbox STRING, x LONG, y LONG").select("bbox", at.alias("p"))
    bounds = corners.groupBy("bbox").agg(F.min("p.lon").alias("a_min_lon"), F.min("p.lat").alias("a_min_lat"),
                                         F.max("p.lon").alias("a_max_lon"), F.max("p.lat").alias("a_max_lat"))
    return bounds.withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years]))) \
        .select("bbox", "year", "a_min_lon", "a_min_lat", "a_max_lon", "a_max_lat")


def _corners(bbox: str, mode: str) -> list[tuple[int, int]]:
    left, bottom, right, top = (int(v) for v in bbox.split(","))
    ends = [(left, bottom), (right, top)]
    return ends if mode == "corners" else [*ends, (right, bottom), (left, top)]


def _cells(df: DataFrame, min_x: str, min_y: str, max_x: str, max_y: str, size: float) -> DataFrame:
    fx = lambda c: F.floor(F.col(c) / F.lit(size))
    return (df.withColumn("_cx", F.explode(F.sequence(fx(min_x), fx(max_x))))
              .withColumn("_cy", F.explode(F.sequence(fx(min_y), fx(max_y)))))


def search(scenes: DataFrame, aois: DataFrame, collection: str | None = "sentinel-2-l2a",
           cell_degrees: float = 1.0) -> DataFrame:
    """J05 + F12: scenes of an area's year whose footprint intersects the area.

    Range join made scalable: both sides are exploded to the grid cells
    their boxes touch and equi-joined on (year, cell), then the exact overlap
    test runs; a pair is emitted only in the cell holding the lower-left
    corner of the overlap, so no de-duplication shuffle is needed.
    """
    s = scenes if collection is None else scenes.where(F.col("collection") == F.lit(collection))
    s = s.withColumn("year", F.year(F.to_date(F.substring("datetime", 1, 10))))
    sc = _cells(s, "min_lon", "min_lat", "max_lon", "max_lat", cell_degrees)
    ac = _cells(aois, "a_min_lon", "a_min_lat", "a_max_lon", "a_max_lat", cell_degrees)
    j = sc.join(ac, ["year", "_cx", "_cy"])
    ok = (geo.boxes_intersect("min_lon", "min_lat", "max_lon", "max_lat",
                              "a_min_lon", "a_min_lat", "a_max_lon", "a_max_lat")
          & (F.col("_cx") == F.floor(F.greatest("min_lon", "a_min_lon") / F.lit(cell_degrees)))
          & (F.col("_cy") == F.floor(F.greatest("min_lat", "a_min_lat") / F.lit(cell_degrees))))
    return j.where(ok).drop("_cx", "_cy")


def search_footprints(scenes: DataFrame, aois: DataFrame, collection: str | None = "sentinel-2-l2a",
                      cell_degrees: float = 1.0) -> DataFrame:
    """J05 on real footprints: scenes of an area's year whose quadrilateral meets the area's.

    Both sides have a convex ring of corners (``footprint`` and ``area``, array<struct<x,y>>).
    Their boxes meet by the equi-join of :func:`search`, which gives each pair once; the
    separating-axis test then decides on the rings themselves.
    """
    f, a = geo.ring_bounds("footprint"), geo.ring_bounds("area")
    boxed = scenes.withColumn("_f", f).withColumns({n: F.col(f"_f.{m}") for n, m in _BOX.items()}).drop("_f")
    areas = aois.withColumn("_a", a).withColumns({f"a_{n}": F.col(f"_a.{m}") for n, m in _BOX.items()}).drop("_a")
    near = search(boxed, areas, collection, cell_degrees)
    return near.where(geo.convex_intersect("footprint", "area")).drop(*_BOX, *[f"a_{n}" for n in _BOX])


_BOX = {"min_lon": "min_x", "min_lat": "min_y", "max_lon": "max_x", "max_lat": "max_y"}


def aoi_rings(spark, bboxes=tuple(K.AOI_BBOXES), years=tuple(K.AOI_YEARS)) -> DataFrame:
    """J02 + T01: areas x years with the ring of the area's reprojected corners."""
    df = spark.createDataFrame([(b,) for b in bboxes], "bbox STRING").withColumn("area", geo.bbox_corners(geo.parse_bbox(F.col("bbox"))))
    return df.withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years])))


def existing_dates(obs: DataFrame, keys=("bbox", "year", "tile")) -> DataFrame:
    """Dates already written per (bbox, year, tile), sorted."""
    return obs.groupBy(*keys).agg(F.sort_array(F.collect_set("scene_date")).alias("dates"))


def skip_existing(candidates: DataFrame, done: DataFrame,
                  keys=("bbox", "year", "tile", "scene_date")) -> DataFrame:
    """Candidates not already written (anti join on the partition keys)."""
    return candidates.join(done.select(*keys).distinct(), list(keys), "left_anti")


def pending_partitions(inputs: DataFrame, outputs: DataFrame, keys=("bbox", "year")) -> DataFrame:
    """Partitions present in the input but not yet in the output (EXCEPT DISTINCT)."""
    return inputs.select(*keys).subtract(outputs.select(*keys))


def pick_tile(scenes: DataFrame, seed: int = 0, tile_col: str = "mgrs") -> DataFrame:
    """Choose one tile by the draw of its whole name and keep its scenes (exact match)."""
    t = F.col(tile_col)
    chosen = scenes.select(tile_col).distinct().orderBy(draw("tile", t, seed=seed), t).limit(1)
    return scenes.join(chosen, tile_col, "left_semi")
