"""Queries that check operators' own outputs: matrices, lookups, extents, storage and the scene chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.indices import ndvi_percent
from cropcube.operators import blocks as BL
from cropcube.operators import loader as L
from cropcube.operators import models as M
from cropcube.operators import observe as OB
from cropcube.operators import raster as R
from cropcube.operators import scenes as SC
from cropcube.operators import series as S
from cropcube.operators import sketches as SK
from cropcube.operators import stats as ST
from cropcube.plans import catalog as C
from cropcube.plans import sql as Q
from cropcube.plans.registry import query
from cropcube.schemas import SERIES_ENCODED
from cropcube.session import materialize, shared_path
from cropcube.sources import fixtures as FX
from cropcube.sources import listing as LI
from cropcube.sources.tables import read_dataset, read_table, write_and_verify

_KEY = Q.SERIES_KEY
_MATRIX = [*K.BANDS, "ndvi", "scl", "day"]


@query("t27_dense_matrix", "T27", sql=Q.with_(Q.TRAIN) + f""",
keys AS (SELECT DISTINCT {_KEY}, start_day, label FROM train_long),
grid AS (SELECT k.*, CAST(s.range AS INTEGER) AS slot FROM keys k, range({L.slot_count()}) s)
SELECT g.*, {', '.join(f'coalesce(t.{c}, 0) AS {c}' for c in _MATRIX)}
FROM grid g LEFT JOIN (SELECT {_KEY}, start_day, slot, {', '.join(_MATRIX)} FROM train_long) t
  USING ({_KEY}, start_day, slot)""")
def t27_dense_matrix(spark, sf):
    """The zero-padded 25 x 15 matrix of every training example, a row for each slot."""
    ex = C.train_examples(spark, sf)
    rows = ex.select(*_KEY.split(", "), "start_day", "label", F.posexplode_outer(L.dense_slots(F.col("slots"))).alias("slot", "m"))
    return rows.select(*_KEY.split(", "), "start_day", "label", F.col("slot").cast("int").alias("slot"),
                       *[F.col("m")[i].alias(c) for i, c in enumerate(_MATRIX)])


@query("t25_ndvi_in_place", "T25 X07", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, CAST(row_number() OVER (PARTITION BY {_KEY} ORDER BY scene_date, tile) - 1 AS INTEGER) AS image_index,
       round(CAST({Q.NIR} - {Q.RED} AS DOUBLE) / nullif(CAST({Q.NIR} + {Q.RED} AS DOUBLE), 0), 6) AS ndvi
FROM obs""")
def t25_ndvi_in_place(spark, sf):
    """NDVI of every image at its place in the series, null where both bands are zero."""
    v = S.with_series_ndvi(C.series(spark, sf))
    return v.select("bbox", "year", "pixel_id", F.posexplode_outer("ndvi").alias("image_index", "v")).where("image_index IS NOT NULL").select(
        "bbox", "year", "pixel_id", F.col("image_index").cast("int").alias("image_index"), F.round("v", 6).alias("ndvi"))


@query("j01_class_rgb", "J01 S06", sql=Q.with_(Q.SAMPLES) + f"""
SELECT raster_id, row, col, code, CDL, CAST(CASE WHEN CDL IS NULL THEN 0 ELSE (code * 67) % 256 END AS INTEGER) AS r,
       CAST(CASE WHEN CDL IS NULL THEN 0 ELSE (code * 131 + 40) % 256 END AS INTEGER) AS g,
       CAST(CASE WHEN CDL IS NULL THEN 0 ELSE (code * 29 + 90) % 256 END AS INTEGER) AS b
FROM samples""")
def j01_class_rgb(spark, sf):
    """Class name and colour of every sample; a code that the dictionary lacks has no name and 0, 0, 0."""
    return C.samples(spark, sf).select("raster_id", "row", "col", "code", "CDL", "r", "g", "b")


@query("t38_scene_assets", "T38 S09", sql=Q.with_(Q.SCENES) + "SELECT scene_id, " + ", ".join(
    f"'s3://scenes/' || scene_id || '/{a}.tif' AS href_{a}" for a in K.ASSETS) + " FROM scenes")
def t38_scene_assets(spark, sf):
    """All 13 asset links of every scene of the parsed catalogue."""
    return SC.parse_catalog(FX.scene_json(spark, sf)).select("scene_id", *[f"href_{a}" for a in K.ASSETS])


@query("f07_incomplete_numbers", "F07", sql="""
SELECT l_orderkey, l_linenumber, l_quantity / l_tax AS ratio FROM (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_tax AS DOUBLE) AS l_tax,
         CAST(l_discount AS DOUBLE) AS l_discount FROM lineitem) WHERE l_tax <> 0 AND l_discount <> 0""")
def f07_incomplete_numbers(spark, sf):
    """Ratios that are infinite (no tax) or undefined (no discount) are incomplete, and their rows go."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount"])
    tax, discount = F.col("l_tax").cast("double"), F.col("l_discount").cast("double")
    ratio = F.when(discount == 0, F.lit(float("nan"))).when(tax == 0, F.lit(float("-inf"))) \
        .otherwise(F.try_divide(F.col("l_quantity").cast("double"), tax))
    return OB.drop_incomplete(li.select("l_orderkey", "l_linenumber", ratio.alias("ratio")))


@query("a13_sample_extent", "A13 J09", sql=Q.with_(Q.SAMPLES) + f""",
centres AS (SELECT raster_id, x0 + (col + 0.5) * 30.0 AS cx, y0 - (row + 0.5) * 30.0 AS cy FROM samples)
SELECT raster_id, min(lon) AS min_lon, max(lon) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat
FROM {Q.albers_inverse('centres', 'cx', 'cy')} GROUP BY raster_id""")
def a13_sample_extent(spark, sf):
    """Extent of the samples of each raster."""
    return ST.extent(R.with_lonlat(C.samples(spark, sf), 6), by=("raster_id",))


def _z(b, m, s):
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE (CAST({b} AS DOUBLE) - {m!r}) / {s!r} END"


_LO, _HI, _BINS = -4.0, 4.0, 8

@query("a16_normalised_distribution", "A16", sql=Q.with_(Q.TRAIN) + ", stacked AS (" + " UNION ALL ".join(
    f"SELECT '{b}' AS band, round({_z(b, m, s)}, 6) AS v FROM train_long"
    for b, m, s in zip(K.BANDS, K.BAND_MEANS, K.BAND_STDS)) + f""")
SELECT band, count(v) AS n, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean,
       round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75,
       count(*) FILTER (WHERE v < {_LO}) AS h_under, count(*) FILTER (WHERE v > {_HI}) AS h_over,
""" + ", ".join(f"count(*) FILTER (WHERE v >= {_LO + i} AND v {'<' if i < _BINS - 1 else '<='} {_LO + i + 1}) AS h{i}"
                for i in range(_BINS)) + " FROM stacked GROUP BY band")
def a16_normalised_distribution(spark, sf):
    """Distribution of the normalised bands, with bins for what lies outside."""
    ex = C.train_examples(spark, sf).select(F.explode_outer("slots").alias("s")).select(
        L.normalise_bands(F.col("s.bands")).alias("z"))
    wide = ex.select(*[F.round(F.col("z")[i], 6).alias(b) for i, b in enumerate(K.BANDS)])
    return ST.band_distribution(wide, K.BANDS, bins=_BINS, lo=_LO, hi=_HI)


@query("m06_fitted_features", "M06 T31", sql=Q.with_(Q.TRAIN) + ", fitted AS (SELECT " + ", ".join(
    f"avg(CAST({b} AS DOUBLE)) FILTER (WHERE {b} <> 0) AS m_{b}, stddev_pop(CAST({b} AS DOUBLE)) FILTER (WHERE {b} <> 0) AS s_{b}"
    for b in K.BANDS) + f""" FROM train_long WHERE year = {K.FIXTURE_SPLIT_YEARS['train']})
SELECT bbox, year, pixel_id, slot, """ + ", ".join(
    f"round(CASE WHEN {b} = 0 THEN 0.0 ELSE (CAST({b} AS DOUBLE) - m_{b}) / s_{b} END, 4) + 0.0 AS z_{b}" for b in K.BANDS)
    + " FROM train_long, fitted")
def m06_fitted_features(spark, sf):
    """All examples normalised by what was fitted on the train year."""
    ex = materialize(C.train_examples(spark, sf), "examples")  # the fit and the features read it
    fitted = L.fit_normaliser(L.slots_long(ex.where(F.col("year") == K.FIXTURE_SPLIT_YEARS["train"])))
    means, stds = M.fitted_stats(fitted)
    z = L.normalise_bands(F.col("s.bands"), means, stds)
    return ex.select("bbox", "year", "pixel_id", F.explode("slots").alias("s")).select(
        "bbox", "year", "pixel_id", F.col("s.slot").alias("slot"), *[F.round(z[i], 4).alias(f"z_{b}") for i, b in enumerate(K.BANDS)])


_STRIDES = (K.STRIDE_DENSE, K.STRIDE_WRITER, K.STRIDE_TRAIN)


@query("l07_strides", "L07", sql=" UNION ALL ".join(
    f"SELECT * FROM ({Q.with_(Q.samples_sql(n))} SELECT {n} AS stride, raster_id, row, col, code FROM samples)" for n in _STRIDES))
def l07_strides(spark, sf):
    """Systematic samples of other strides, each raster from its drawn start, in one scan of the strips."""
    strips = FX.raster_strips(spark, sf).withColumn("stride", F.explode(F.array(*[F.lit(n) for n in _STRIDES])))
    one = R.grid_sample(strips, F.col("stride"), start=R.seeded_start(F.col("raster_id"), F.col("stride")), keep=("stride",))
    return one.select("stride", "raster_id", "row", "col", "code")


@query("f11_crop", "F11", sql=Q.with_(Q.CELLS) + "SELECT raster_id, row, col, code FROM pixels WHERE row < 800 AND col < 800")
def f11_crop(spark, sf):
    """The upper left 800 x 800 cells of each raster, as for a display."""
    return R.crop_grid(R.raster_pixels(FX.raster_strips(spark, sf))).select("raster_id", "row", "col", "code")


_POINT = 17  # a pixel of the fixture grid, looked up by its coordinates


@query("f05_point_by_lonlat", "F05", sql=Q.with_(Q.OBS) + f""",
gridded AS (SELECT *, {FX.PIXEL_X_SQL} AS gx,
                   {FX.PIXEL_Y_SQL} AS gy FROM obs),
located AS (SELECT * FROM {Q.albers_inverse('gridded', 'gx', 'gy')}),
point AS (SELECT DISTINCT lon, lat FROM located WHERE pixel_id = {_POINT})
SELECT pixel_id, scene_date, tile, lon, lat, {Q.NDVI100} AS ndvi100 FROM located SEMI JOIN point USING (lon, lat)""")
def f05_point_by_lonlat(spark, sf):
    """Observations at one point, found by equality of its DOUBLE longitude and latitude."""
    at = spark.range(1).select(FX.pixel_lonlat(F.lit(_POINT)).alias("p")).first().p
    ll = FX.pixel_lonlat("pixel_id")
    obs = C.observations(spark, sf).withColumn("_ll", ll)
    hit = obs.where((F.col("_ll.lon") == F.lit(at.lon)) & (F.col("_ll.lat") == F.lit(at.lat)))
    return hit.select("pixel_id", "scene_date", "tile", F.col("_ll.lon").alias("lon"), F.col("_ll.lat").alias("lat"),
                      ndvi_percent("red", "nir").alias("ndvi100"))


_PART_BBOX, _PART_YEAR = K.AOI_BBOXES[2], 1997


@query("s02_storage_roundtrip", "S01 S02 S03 S10 S13 S16 T23 F05", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, CDL,
       CAST(row_number() OVER (PARTITION BY {_KEY} ORDER BY scene_date, tile) - 1 AS INTEGER) AS image_index,
       scene_date, tile, scl, {Q.BAND_LIST}, (SELECT count(*) FROM (SELECT DISTINCT bbox, year FROM obs)) AS n_partitions
FROM obs WHERE bbox = '{_PART_BBOX}' AND year = {_PART_YEAR}""")
def s02_storage_roundtrip(spark, sf):
    """Encoded series written by (bbox, year); one partition re-read with an explicit schema, pruned, and decoded."""
    path = shared_path(spark, "series")
    write_and_verify(S.encode_series(C.series(spark, sf)), path)
    n = LI.partitions(LI.list_files(spark, path), "bbox string, year int").count()
    one = read_dataset(spark, path, schema=SERIES_ENCODED,
                       where=(F.col("bbox") == _PART_BBOX) & (F.col("year") == _PART_YEAR))
    return S.explode_images(S.decode_series(one)).withColumn("n_partitions", F.lit(n).cast("bigint"))


_USABLE = " + ".join(K.USABLE_AREA_PROPERTIES)


@query("j04_scene_chain", "S09 F12 W03 J03 F08 J04 F06 F07 T06", sql=Q.with_(Q.SCENES, Q.RAW_OBS) + f""",
latest AS (
  SELECT split_part(scene_id, '_', 2) AS mgrs, CAST(substr(datetime, 1, 10) AS DATE) AS scene_date,
         CAST(split_part(scene_id, '_', -2) AS INTEGER) AS seq, {_USABLE} AS usable, min_lon, min_lat, max_lon, max_lat
  FROM scenes_full WHERE collection = '{FX.SCENE_COLLECTION}'
  QUALIFY row_number() OVER (PARTITION BY split_part(scene_id, '_', 2), substr(datetime, 1, 10)
                             ORDER BY CAST(split_part(scene_id, '_', -2) AS INTEGER) DESC) = 1),
wanted AS (SELECT * FROM latest WHERE usable > {float(K.USABLE_AREA_THRESHOLD)!r} AND month(scene_date) > 1),
attrs AS (
  SELECT *, {Q.AOI_LIST}[CAST(pixel_id % 7 AS INTEGER) + 1] AS bbox, {Q.class_case('pixel_id % 12')} AS CDL,
         {FX.PIXEL_X_SQL} AS gx,
         {FX.PIXEL_Y_SQL} AS gy FROM raw_obs),
located AS (SELECT * FROM {Q.albers_inverse('attrs', 'gx', 'gy')})
SELECT bbox, year, pixel_id, CDL, scene_date, mgrs || '_' || CAST(seq AS VARCHAR) AS tile, scl, {Q.BAND_LIST}
FROM located JOIN wanted USING (mgrs, scene_date, seq)
WHERE scl NOT IN ({Q.SCL_EXCLUDE}) AND CDL IS NOT NULL
  AND lon BETWEEN min_lon AND max_lon AND lat BETWEEN min_lat AND max_lat""")
def j04_scene_chain(spark, sf):
    """Catalogue to observations: parse, keep the latest processing, skip what exists, keep usable
    scenes, and only then read their blocks, observe samples and filter.

    Scenes of each January stand for those already written.
    """
    parsed = SC.scene_keys(SC.parse_catalog(FX.scene_json(spark, sf)))
    latest = SC.keep_latest(parsed.where(F.col("collection") == FX.SCENE_COLLECTION)).withColumn("year", F.year("scene_date"))
    done = latest.where(F.month("scene_date") == 1)
    todo = SC.usable_scenes(SC.skip_existing(latest, done, ("scene_id",)))
    wanted = todo.select("mgrs", "year", "scene_date", "seq", "min_lon", "min_lat", "max_lon", "max_lat")
    blocks = BL.write_blocks(FX.scene_blocks(spark, sf))
    smp = FX.samples_from_observations(spark, sf)
    smp = smp.select("*", F.inline_outer(F.array(FX.pixel_lonlat("pixel_id"))))
    tiles = wanted.select("mgrs", "year", "min_lon", "min_lat", "max_lon", "max_lat").distinct()
    obs = BL.observe_blocks(OB.sample_cells(smp, tiles, FX.scene_cell), blocks, wanted)
    obs = OB.quality_filter(obs.withColumn("tile", F.concat_ws("_", "mgrs", F.col("seq").cast("string"))))
    return obs.select("bbox", "year", "pixel_id", "CDL", "scene_date", "tile", "scl", *K.BANDS)


_RANKS = (0.05, 0.25, 0.5, 0.75, 0.95)


@query("a16_sketch_quantiles", "A16", sql=Q.with_(Q.TRAIN) + ", stacked AS (" + " UNION ALL ".join(
    f"SELECT '{b}' AS band, {b} AS v FROM train_long WHERE {b} <> 0" for b in K.BANDS) + f""")
SELECT band, r.rank, count(*) AS n, true AS within FROM stacked CROSS JOIN (VALUES {', '.join(f'(CAST({q} AS DOUBLE))' for q in _RANKS)}) AS r(rank)
GROUP BY band, r.rank""")
def a16_sketch_quantiles(spark, sf):
    """Quantiles from sketches kept for each (bbox, year) and merged; their true ranks lie within the stated error."""
    long = materialize(L.slots_long(C.train_examples(spark, sf)).select("bbox", "year", *K.BANDS), "slots")
    found = SK.quantiles(SK.merge_sketches(SK.band_sketches(long)), _RANKS)
    values = long.select(F.inline(F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("v")) for b in K.BANDS]))).where("v <> 0")
    per_value = values.groupBy("band", "v").agg(F.count("*").alias("c"))
    at = per_value.join(found, "band").groupBy("band", "rank", "n").agg(
        F.sum(F.when(F.col("v") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto"))
    within = (F.col("below") / F.col("n") <= F.col("rank") + SK.RANK_ERROR) & (F.col("upto") / F.col("n") >= F.col("rank") - SK.RANK_ERROR)
    return at.select("band", "rank", "n", within.alias("within"))
