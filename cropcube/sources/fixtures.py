"""Views of the crop data model over the driver's tables (FIXTURES.md section 2).

The test tables hold no rasters or scenes, so these views derive them with
integer arithmetic from ``lineitem`` (observations, scenes) and ``part``
(label rasters).  Every formula is plain integer SQL, so an independent SQL
engine computes the same rows.  All views are lazy DataFrames: Catalyst
prunes the columns a query does not use and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions import geo
from cropcube.functions.hof import let
from cropcube.functions.labels import lookup
from cropcube.sources.tables import read_table

# --- fixture design values (not semantics of the original) ---
FIXTURE_CLASSES = {
    0: "Soybeans", 1: "Rice", 2: "Corn", 3: "Cotton", 4: "Winter Wheat",
    5: "Peanuts", 6: "Woody Wetlands", 7: "Dbl Crop WinWht/Soybeans",
    8: "Open Water", 9: "Sorghum", 10: "Developed/Open Space",
}  # code 11 is missing on purpose: it maps to a null class
NUM_FIXTURE_CODES = 12
GRID_WIDTH = 40                 # observation pixels per grid row
CELL = 30
_LEFT, _TOP = ([int(b.split(",")[i]) for b in K.AOI_BBOXES] for i in (0, 3))
# a pixel's own area (pixel_id % 7) and its place in that area's grid
PIXEL_X_SQL = f"({_LEFT}[CAST(pixel_id % 7 AS INTEGER) + 1] + {CELL} * ((pixel_id // 7) % {GRID_WIDTH}))"
PIXEL_Y_SQL = f"({_TOP}[CAST(pixel_id % 7 AS INTEGER) + 1] - {CELL} * ((pixel_id // 7) // {GRID_WIDTH}))"
RASTER_WIDTH = 50               # label-raster cells per row
RASTER_YEARS = [1998, 1999, 2000]
BAND_MULTIPLIERS = [(7919 + 13 * i, 104729 + 29 * i, 31 + i) for i in range(12)]
PERCENT_PAIRS = [(3, 7), (5, 11), (7, 13), (11, 17), (13, 19)]
SCENE_COLLECTION = "sentinel-2-l2a"


def class_dictionary(spark: SparkSession) -> DataFrame:
    """code -> class name and RGB (the dimension behind lookups J01/S06).

    Codes are 8-bit raster values, so the table is bounded (<= 256 rows)
    and is always safe to broadcast.
    """
    rows = [(c, n, (c * 67) % 256, (c * 131 + 40) % 256, (c * 29 + 90) % 256)
            for c, n in FIXTURE_CLASSES.items()]
    rows.append((NUM_FIXTURE_CODES + 1, None, 0, 0, 0))  # a header-like row without a name
    return spark.createDataFrame(rows, "code INT, class_name STRING, r INT, g INT, b INT")


def class_name(code) -> F.Column:
    return lookup(FIXTURE_CLASSES, code)


def aoi_of(index) -> F.Column:
    return F.element_at(F.array(*[F.lit(b) for b in K.AOI_BBOXES]), (index + F.lit(1)).cast("int"))


def pixel_lonlat(pixel_id, digits: int = 6) -> F.Column:
    """Observation pixel -> struct<lon, lat> (cell of its own area's EPSG:5070 grid -> 4326)."""
    pid = F.col(pixel_id) if isinstance(pixel_id, str) else pixel_id
    place = F.floor(pid / 7)
    corner = [F.element_at(F.array(*[F.lit(v) for v in side]), (pid % 7 + 1).cast("int")) for side in (_LEFT, _TOP)]
    return geo.albers_to_lonlat(corner[0] + F.lit(CELL) * (place % GRID_WIDTH),
                                corner[1] - F.lit(CELL) * F.floor(place / GRID_WIDTH), digits)


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (pixel, scene) before de-duplication and quality filter.

    Columns: pixel_id, year, scene_date, mgrs, seq, scl, <12 bands>.
    """
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        "l_linestatus", "l_shipdate"], deal_by=["l_suppkey"])
    bands = [f"CAST((l_orderkey * {a}L + l_partkey * {b}L + l_linenumber * {c}L) % 10000 AS INT) AS {name}"
             for name, (a, b, c) in zip(K.BANDS, BAND_MULTIPLIERS)]
    return li.selectExpr(
        "l_suppkey AS pixel_id", "CAST(year(l_shipdate) AS INT) AS year", "CAST(l_shipdate AS DATE) AS scene_date",
        "concat(l_returnflag, l_linestatus) AS mgrs", "CAST(l_linenumber AS INT) AS seq",
        "CAST((l_orderkey + l_partkey) % 12 AS INT) AS scl", *bands)


def with_pixel_attributes(df: DataFrame) -> DataFrame:
    """Add bbox, class code and class name, which depend on the pixel only."""
    pid = F.col("pixel_id")
    return df.withColumns({
        "bbox": aoi_of(pid % 7),
        "cdl_code": (pid % NUM_FIXTURE_CODES).cast("int"),
        "CDL": class_name((pid % NUM_FIXTURE_CODES).cast("int")),
    })


def samples_from_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label samples (bbox, year, CDL, pixel) that the observations cover."""
    raw = raw_observations(spark, sf_dir).select("pixel_id", "year").distinct()
    return with_pixel_attributes(raw)


def observations(spark: SparkSession, sf_dir: str, quality_filter: bool = True) -> DataFrame:
    """Observations: one per (pixel, year, scene date, mgrs) with tile and class.

    The latest processing wins (highest seq, then scl, then every band), the
    same rule the scene catalogue uses.  ``quality_filter`` applies the SCL
    exclusion and drops rows with a null class (the original's dropna).
    """
    from cropcube.operators.observe import latest_per_key, quality_filter as qf

    raw = raw_observations(spark, sf_dir)
    obs = latest_per_key(raw, ["pixel_id", "year", "scene_date", "mgrs"],
                         ["seq", "scl", *K.BANDS])
    obs = with_pixel_attributes(obs).withColumn("tile", F.concat_ws("_", "mgrs", F.col("seq").cast("string")))
    if quality_filter:
        obs = qf(obs)
    return obs


def raster_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rasters as strips: one row per raster row with its cell values.

    ``part`` gives the cells: AOI ``p_partkey % 7``, cell index
    ``p_partkey div 7`` laid out ``RASTER_WIDTH`` per row; one raster per AOI
    and year (years 1998-2000), class code ``(p_size + year) % 12``.
    Grid origin is the AOI's top-left corner, 30 m cells.
    """
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_size"])
    cells = part.select(
        (F.col("p_partkey") % 7).cast("int").alias("aoi"),
        F.floor(F.col("p_partkey") / 7).alias("j"),
        "p_size",
        F.explode(F.array(*[F.lit(y) for y in RASTER_YEARS])).alias("year"),
    ).select(
        "aoi", "year",
        F.floor(F.col("j") / RASTER_WIDTH).cast("int").alias("row"),
        (F.col("j") % RASTER_WIDTH).cast("int").alias("col"),
        ((F.col("p_size") + F.col("year")) % NUM_FIXTURE_CODES).cast("int").alias("code"),
    )
    strips = cells.groupBy("aoi", "year", "row").agg(
        F.array_sort(F.collect_list(F.struct("col", "code"))).alias("cells"))
    box = geo.parse_bbox(aoi_of(F.col("aoi")))
    return strips.select(
        F.concat(F.lit("cdl_"), F.col("aoi").cast("string"), F.lit("_"), F.col("year").cast("string")).alias("raster_id"),
        aoi_of(F.col("aoi")).alias("bbox"),
        "year", "row",
        F.transform("cells", lambda c: c["code"]).alias("values"),
        box["left"].cast("double").alias("x0"),
        box["top"].cast("double").alias("y0"),
        F.lit(float(CELL)).alias("dx"),
        F.lit(float(CELL)).alias("dy"),
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene catalogue rows: distinct (mgrs, date, seq) of ``lineitem``.

    id ``S2A_<mgrs>_<yyyyMMdd>_<seq>_L2A``; the five area percentages are
    ``(day_of_year * p + seq * q) % 40``; footprint: a 1.2 x 1.2 degree box
    placed by the mgrs letters.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate"])
    d = li.select(F.concat("l_returnflag", "l_linestatus").alias("mgrs"),
                  F.col("l_shipdate").cast("date").alias("scene_date"),
                  F.col("l_linenumber").cast("int").alias("seq")).distinct()
    doy = F.dayofyear("scene_date")
    pct = {name: ((doy * p + F.col("seq") * q) % 40).cast("double")
           for name, (p, q) in zip(K.USABLE_AREA_PROPERTIES, PERCENT_PAIRS)}
    min_lon = F.lit(-92.0) + (F.ascii(F.substring("mgrs", 1, 1)) % 3).cast("double") * F.lit(0.8)
    min_lat = F.lit(34.0) + (F.ascii(F.substring("mgrs", 2, 1)) % 2).cast("double") * F.lit(1.1)
    return d.select(
        F.concat(F.lit("S2A_"), "mgrs", F.lit("_"), F.date_format("scene_date", "yyyyMMdd"),
                 F.lit("_"), F.col("seq").cast("string"), F.lit("_L2A")).alias("scene_id"),
        F.lit(SCENE_COLLECTION).alias("collection"),
        F.concat(F.date_format("scene_date", "yyyy-MM-dd"), F.lit("T16:45:00Z")).alias("datetime"),
        *[pct[n].alias(n) for n in K.USABLE_AREA_PROPERTIES],
        min_lon.alias("min_lon"), min_lat.alias("min_lat"),
        (min_lon + F.lit(1.2)).alias("max_lon"), (min_lat + F.lit(1.2)).alias("max_lat"),
    )


def scene_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as JSON feature text, one feature per row (S09 input).

    The text is made by a generator, so filters on what it holds stay above it: pushed below
    the ``distinct`` of the scenes they would write and parse it for every ``lineitem`` row.
    """
    s = scenes(spark, sf_dir)
    props = F.struct(
        F.col("datetime").alias("datetime"),
        *[F.col(n).alias(f"s2:{n}") for n in K.USABLE_AREA_PROPERTIES])
    assets = F.create_map(*[x for a in K.ASSETS for x in (
        F.lit(a), F.struct(F.concat(F.lit("s3://scenes/"), F.col("scene_id"), F.lit(f"/{a}.tif")).alias("href")))])
    feature = F.struct(
        F.col("scene_id").alias("id"), F.col("collection"),
        F.array("min_lon", "min_lat", "max_lon", "max_lat").alias("bbox"),
        props.alias("properties"), assets.alias("assets"))
    return s.select(F.explode_outer(F.array(F.to_json(feature))).alias("json"))


UTM_ZONE = 15
SCENE_CELL = 10.0


def tile_grid_origin(mgrs) -> tuple[F.Column, F.Column]:
    """Upper-left corner (UTM zone 15 metres) of a tile's 10 m grid."""
    m = F.col(mgrs) if isinstance(mgrs, str) else mgrs
    x0 = F.lit(399960.0) + (F.ascii(F.substring(m, 1, 1)) % 3).cast("double") * F.lit(20.0)
    y0 = F.lit(4000020.0) - (F.ascii(F.substring(m, 2, 1)) % 2).cast("double") * F.lit(20.0)
    return x0, y0


def scene_cell(lon, lat, mgrs) -> F.Column:
    """lon/lat -> UTM -> (row, col) of the tile's 10 m grid."""
    x0, y0 = tile_grid_origin(mgrs)
    return let(geo.lonlat_to_utm(lon, lat, F.lit(UTM_ZONE)), lambda u: geo.cell_of(
        u["x"], u["y"], x0, y0, F.lit(SCENE_CELL), F.lit(SCENE_CELL)))


def scene_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene rasters as cells: one row per (scene, cell) with the 13 assets.

    Each ``lineitem`` row is the value of one scene at the cell holding its
    pixel; the cell is found with the same projection a sample uses, where the row is
    read: a lookup of cells would move all values once more.
    """
    raw = raw_observations(spark, sf_dir).select("*", F.inline_outer(F.array(pixel_lonlat("pixel_id"))))
    raw = raw.select("*", F.inline_outer(F.array(scene_cell(F.col("lon"), F.col("lat"), F.col("mgrs")))))
    return raw.select(
        F.concat(F.lit("S2A_"), "mgrs", F.lit("_"), F.date_format("scene_date", "yyyyMMdd"),
                 F.lit("_"), F.col("seq").cast("string"), F.lit("_L2A")).alias("scene_id"),
        "mgrs", "year", "scene_date", "seq", "row", "col",
        "scl", *K.BANDS)


def scene_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene rasters as blocks of cells, a row for each scene, asset and block.

    A cell has one value in a raster, so what ``lineitem`` gives a scene's cell again comes
    as another delivery of the scene (numbered from 0, the greatest values first).
    """
    from cropcube.operators.blocks import BLOCK_KEY, gathered, to_blocks

    cells = gathered(scene_pixels(spark, sf_dir))
    again = Window.partitionBy(*BLOCK_KEY, "scene_id", "at").orderBy(*[F.col(a).desc() for a in K.ASSETS])
    return to_blocks(cells.withColumn("delivery", F.row_number().over(again) - 1))


def scene_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes with the quadrilateral that they cover: their box turned within itself, more for higher numbers."""
    s = scenes(spark, sf_dir)
    turn = F.lit(0.1) + F.lit(0.1) * (F.element_at(F.split("scene_id", "_"), -2).cast("int") % 4).cast("double")
    corners = [(F.col("min_lon") + turn, F.col("min_lat")), (F.col("max_lon"), F.col("min_lat") + turn),
               (F.col("max_lon") - turn, F.col("max_lat")), (F.col("min_lon"), F.col("max_lat") - turn)]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])
    return s.select("scene_id", "collection", "datetime", ring.alias("footprint"))
