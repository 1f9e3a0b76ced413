"""Registered queries: one per operator group of the inventory, each with its
independent SQL oracle (or ``sql=None`` for ML / streaming / file metadata).

Every query reads the driver's tables (through the fixture views) in full;
no query filters ids or caps rows to make the check cheap.  Limits appear
only where the limit is the feature (top-k, first-n examples).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions import codec, geo
from cropcube.functions.draws import draw_sql
from cropcube.functions.indices import ndvi, ndvi_percent
from cropcube.functions.labels import legend_name, scl_name
from cropcube.operators import blocks as BL
from cropcube.operators import evaluate as EV
from cropcube.operators import loader as L
from cropcube.operators import observe as OB
from cropcube.operators import raster as R
from cropcube.operators import scenes as SC
from cropcube.operators import series as S
from cropcube.operators.sampling import hash_sample
from cropcube.operators import stats as ST
from cropcube.plans import sql as Q
from cropcube.plans.registry import query
from cropcube.sources import fixtures as FX
from cropcube.sources.tables import read_table

SAMPLE_STRIDE = K.STRIDE_DEFAULT


# ---------------------------------------------------------------- shared views

def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Label samples: every 3rd cell of each raster from a drawn start, named."""
    strips = FX.raster_strips(spark, sf)
    px = R.grid_sample(strips, SAMPLE_STRIDE, start=R.seeded_start(F.col("raster_id"), SAMPLE_STRIDE))
    return OB.attach_class_names(px, FX.class_dictionary(spark), "code")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return FX.observations(spark, sf)


def series(spark: SparkSession, sf: str) -> DataFrame:
    return S.build_series(observations(spark, sf))


def train_examples(spark: SparkSession, sf: str) -> DataFrame:
    return L.training_examples(series(spark, sf))


def sweep(spark: SparkSession, sf: str) -> DataFrame:
    return L.sweep_examples(series(spark, sf))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Sweep x scorer -> results table (key, lon/lat, labels, dates)."""
    scored = EV.linear_scores(sweep(spark, sf))
    ll = FX.pixel_lonlat("pixel_id")
    return scored.select(
        "bbox", "year", "pixel_id", F.col("CDL").alias("raw_cdl"), "start_day",
        ll["lat"].alias("latitude"), ll["lon"].alias("longitude"),
        F.col("label").alias("true_label"), "prediction",
        (F.col("start_day") + F.lit(K.DAYS_IN_SERIES)).alias("prediction_day"),
        EV.prediction_date(F.col("year"), F.col("start_day")).alias("prediction_date"))


SCORE_SQL = ",\n".join(
    f"  sum({' + '.join(f'CAST({b} AS BIGINT) * ({EV.scorer_weight(c, i)})' for i, b in enumerate(K.BANDS))}) AS s{c}"
    for c in range(K.NUM_CLASSES))
PRED_SQL = Q.SWEEP + f""",
scores AS (
  SELECT bbox, year, pixel_id, CDL, start_day, label,
{SCORE_SQL}
  FROM sweep_long GROUP BY bbox, year, pixel_id, CDL, start_day, label),
preds AS (
  SELECT *, CAST(list_position([{', '.join(f's{c}' for c in range(K.NUM_CLASSES))}],
                               greatest({', '.join(f's{c}' for c in range(K.NUM_CLASSES))})) - 1 AS INTEGER) AS prediction
  FROM scores),
results AS (
  SELECT bbox, year, pixel_id, CDL AS raw_cdl, start_day, label AS true_label, prediction,
         start_day + {K.DAYS_IN_SERIES} AS prediction_day,
         CAST(make_date(year, 1, 1) + (start_day + {K.DAYS_IN_SERIES - 1}) AS DATE) AS prediction_date,
         {FX.PIXEL_X_SQL} AS gx,
         {FX.PIXEL_Y_SQL} AS gy
  FROM preds),
results_ll AS (
  SELECT * FROM {Q.albers_inverse('results', 'gx', 'gy')})"""


# ---------------------------------------------------------------- step 1: class statistics

@query("a01_class_share", "A01 W01 T37 S05 S06 S07 S08 S14 L07 J01 J02 F01 F02", sql=Q.with_(Q.SAMPLES) + """,
counts AS (SELECT year, CDL, count(CDL) AS count FROM samples GROUP BY year, CDL)
SELECT year, CDL, count, CAST(sum(count) OVER (PARTITION BY year) AS BIGINT) AS total_count,
       round(CAST(count AS DOUBLE) * 100.0 / CAST(sum(count) OVER (PARTITION BY year) AS DOUBLE), 2) AS percentage
FROM counts""")
def a01_class_share(spark, sf):
    return ST.class_share(samples(spark, sf)).select("year", "CDL", "count", "total_count", "percentage")


@query("w02_top_classes", "W02 L03 L02", sql=Q.with_(Q.SAMPLES) + """,
counts AS (SELECT year, CDL, count(CDL) AS count FROM samples GROUP BY year, CDL),
share AS (
  SELECT year, CDL, count, CAST(sum(count) OVER (PARTITION BY year) AS BIGINT) AS total_count,
         round(CAST(count AS DOUBLE) * 100.0 / CAST(sum(count) OVER (PARTITION BY year) AS DOUBLE), 2) AS percentage
  FROM counts)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY percentage DESC, count DESC, CDL ASC NULLS LAST) AS INTEGER) AS row_num
  FROM share) WHERE row_num <= 5""")
def w02_top_classes(spark, sf):
    share = ST.class_share(samples(spark, sf))
    return ST.top_classes(share, 5).select("year", "CDL", "count", "total_count", "percentage", "row_num")


@query("a03_value_shares", "A03 F10", sql=Q.with_(Q.SAMPLES) + """,
counts AS (SELECT bbox, year, CDL, count(*) AS count FROM samples GROUP BY bbox, year, CDL),
pct AS (SELECT *, CAST(count AS DOUBLE) * 100.0 / CAST(sum(count) OVER (PARTITION BY bbox, year) AS DOUBLE) AS p FROM counts)
SELECT bbox, year, CDL, count, round(p, 6) AS percent FROM pct WHERE p >= 1.0""")
def a03_value_shares(spark, sf):
    out = ST.value_shares(samples(spark, sf), ("bbox", "year"), "CDL", min_percent=1)
    return out.select("bbox", "year", "CDL", "count", F.round("percent", 6).alias("percent"))


_PIVOT_CLASSES = list(FX.FIXTURE_CLASSES.values())


def _pivot_col(name: str) -> str:
    return "pct_" + "".join(ch if ch.isalnum() else "_" for ch in name).lower()


@query("a14_aoi_class_table", "A14 A21", sql=Q.with_(Q.SAMPLES) + """,
counts AS (SELECT bbox, year, CDL, count(*) AS count FROM samples GROUP BY bbox, year, CDL),
pct AS (SELECT *, CAST(count AS DOUBLE) * 100.0 / CAST(sum(count) OVER (PARTITION BY bbox, year) AS DOUBLE) AS p FROM counts)
SELECT bbox, year, CAST(sum(count) AS BIGINT) AS size,
""" + ",\n".join(f"  CAST(coalesce(max(CASE WHEN CDL = '{c}' THEN CAST(trunc(p) AS INTEGER) END), 0) AS INTEGER) AS {_pivot_col(c)}"
                 for c in _PIVOT_CLASSES) + "\nFROM pct GROUP BY bbox, year")
def a14_aoi_class_table(spark, sf):
    shares = ST.value_shares(samples(spark, sf), ("bbox", "year"), "CDL")
    t = ST.aoi_class_table(shares, _PIVOT_CLASSES)
    return t.select("bbox", "year", "size", *[F.col(f"`{c}`").cast("int").alias(_pivot_col(c)) for c in _PIVOT_CLASSES])


@query("a21_grid_shape", "A21 S07", sql=Q.with_(Q.CELLS) + """
SELECT raster_id, CAST(max(row) + 1 AS INTEGER) AS n_rows, CAST(max(col) + 1 AS INTEGER) AS n_cols
FROM pixels GROUP BY raster_id""")
def a21_grid_shape(spark, sf):
    return ST.grid_shape(FX.raster_strips(spark, sf)).select(
        "raster_id", F.col("n_rows").cast("int").alias("n_rows"), F.col("n_cols").cast("int").alias("n_cols"))


@query("j08_densify", "J08 S07 L07", sql=Q.with_(Q.SAMPLES) + """
SELECT p.raster_id, p.row, p.col, coalesce(s.code, 0) AS code
FROM pixels p LEFT JOIN samples s USING (raster_id, row, col)""")
def j08_densify(spark, sf):
    strips = FX.raster_strips(spark, sf)
    smp = R.grid_sample(strips, SAMPLE_STRIDE, start=R.seeded_start(F.col("raster_id"), SAMPLE_STRIDE))
    return R.densify(strips, smp, "code")


@query("j09_sample_subset", "J09 A13 A05", sql=Q.with_(Q.SAMPLES) + """
SELECT s.raster_id, count(*) AS n_samples,
       count(*) FILTER (WHERE p.raster_id IS NULL) AS n_outside,
       CAST(min(s.row) AS INTEGER) AS min_row, CAST(max(s.row) AS INTEGER) AS max_row,
       CAST(min(s.col) AS INTEGER) AS min_col, CAST(max(s.col) AS INTEGER) AS max_col
FROM samples s LEFT JOIN pixels p USING (raster_id, row, col)
GROUP BY s.raster_id""")
def j09_sample_subset(spark, sf):
    strips = FX.raster_strips(spark, sf)
    smp = R.grid_sample(strips, SAMPLE_STRIDE, start=R.seeded_start(F.col("raster_id"), SAMPLE_STRIDE))
    outside = R.samples_outside_grid(strips, smp).groupBy("raster_id").agg(F.count("*").alias("n_outside"))
    ext = smp.groupBy("raster_id").agg(
        F.count("*").alias("n_samples"), F.min("row").alias("min_row"), F.max("row").alias("max_row"),
        F.min("col").alias("min_col"), F.max("col").alias("max_col"))
    return ext.join(outside, "raster_id", "left").select(
        "raster_id", "n_samples", F.coalesce("n_outside", F.lit(0)).cast("bigint").alias("n_outside"),
        "min_row", "max_row", "min_col", "max_col")


@query("t05_sample_lonlat", "T04 T05 D4", sql=Q.with_(Q.SAMPLES) + f""",
centres AS (
  SELECT raster_id, bbox, year, row, col, CDL, x0 + (col + 0.5) * 30.0 AS cx, y0 - (row + 0.5) * 30.0 AS cy
  FROM samples)
SELECT raster_id, bbox, year, row, col, CDL, lon, lat FROM {Q.albers_inverse('centres', 'cx', 'cy')}""")
def t05_sample_lonlat(spark, sf):
    px = R.with_lonlat(samples(spark, sf), 6)
    return px.select("raster_id", "bbox", "year", "row", "col", "CDL", "lon", "lat")


_T02_SQL = (Q.with_(Q.SAMPLES) + """,
aoi_p AS (
  SELECT bbox, CAST(string_split(bbox, ', ')[1] AS BIGINT) AS l, CAST(string_split(bbox, ', ')[2] AS BIGINT) AS b,
         CAST(string_split(bbox, ', ')[3] AS BIGINT) AS r, CAST(string_split(bbox, ', ')[4] AS BIGINT) AS t
  FROM (SELECT DISTINCT bbox FROM samples)),
corners AS (
  SELECT bbox, 'll' AS k, l AS cx, b AS cy FROM aoi_p UNION ALL SELECT bbox, 'lr', r, b FROM aoi_p
  UNION ALL SELECT bbox, 'ur', r, t FROM aoi_p UNION ALL SELECT bbox, 'ul', l, t FROM aoi_p),
corner_ll AS (SELECT * FROM """ + Q.albers_inverse("corners", "cx", "cy", digits=None) + """)
SELECT bbox, round(min(lon), 6) AS env_min_lon, round(min(lat), 6) AS env_min_lat,
       round(max(lon), 6) AS env_max_lon, round(max(lat), 6) AS env_max_lat,
       round(max(lon) FILTER (WHERE k = 'll'), 6) AS cor_min_lon, round(max(lat) FILTER (WHERE k = 'll'), 6) AS cor_min_lat,
       round(max(lon) FILTER (WHERE k = 'ur'), 6) AS cor_max_lon, round(max(lat) FILTER (WHERE k = 'ur'), 6) AS cor_max_lat,
       """ + ", ".join(f"round({x}(lon), 6) AS ring_{i}_x, round({y}(lat), 6) AS ring_{i}_y"
                       for i, (x, y) in enumerate([("min", "min"), ("max", "min"), ("max", "max"), ("min", "max"), ("min", "min")]))
           + """, bbox AS bbox_text
FROM corner_ll GROUP BY bbox""")


@query("t02_aoi_bounds", "T01 T02 T03 A13 D3 Q12", sql=_T02_SQL)
def t02_aoi_bounds(spark, sf):
    """AOI boxes of the samples: EPSG:5070 text -> lon/lat bounds (both modes) and ring."""
    aois = samples(spark, sf).select("bbox").distinct()
    box = geo.parse_bbox(F.col("bbox"))
    b = aois.withColumns({"env": geo.bbox_to_lonlat(box, "envelope"), "cor": geo.bbox_to_lonlat(box, "corners")})
    b = b.withColumn("ring", geo.bounds_ring(F.col("env.min_lon"), F.col("env.min_lat"),
                                             F.col("env.max_lon"), F.col("env.max_lat")))
    fields = ("min_lon", "min_lat", "max_lon", "max_lat")
    return b.select("bbox", *[F.round(F.col(f"env.{c}"), 6).alias(f"env_{c}") for c in fields],
                    *[F.round(F.col(f"cor.{c}"), 6).alias(f"cor_{c}") for c in fields],
                    *[F.round(F.get("ring", F.lit(i))[c], 6).alias(f"ring_{i}_{c}") for i in range(5) for c in ("x", "y")],
                    geo.bounds_text(box["left"], box["bottom"], box["right"], box["top"]).alias("bbox_text"))


# ---------------------------------------------------------------- step 2: observations and series

@query("f06_observations", "F06 F07 F04 W03 D6 S01", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, CDL, scene_date, tile, scl, {Q.BAND_LIST} FROM obs""")
def f06_observations(spark, sf):
    return observations(spark, sf).select("bbox", "year", "pixel_id", "CDL", "scene_date", "tile", "scl", *K.BANDS)


@query("a01_observation_class_share", "A01 W01 Q1 Q24", sql=Q.with_(Q.OBS) + """,
counts AS (SELECT year, CDL, count(CDL) AS count FROM obs_all GROUP BY year, CDL)
SELECT year, CDL, count, CAST(sum(count) OVER (PARTITION BY year) AS BIGINT) AS total_count,
       round(CAST(count AS DOUBLE) * 100.0 / CAST(sum(count) OVER (PARTITION BY year) AS DOUBLE), 2) AS percentage
FROM counts""")
def a01_observation_class_share(spark, sf):
    obs = FX.observations(spark, sf, quality_filter=False)
    return ST.class_share(obs).select("year", "CDL", "count", "total_count", "percentage")


@query("a02_class_year_counts", "A02 T19", sql=Q.with_(Q.OBS) + """
SELECT CDL, year, count(*) AS count FROM (SELECT DISTINCT bbox, year, pixel_id, CDL FROM obs) GROUP BY CDL, year""")
def a02_class_year_counts(spark, sf):
    enc = S.encode_series(series(spark, sf))
    dec = enc.withColumn("CDL", codec.decode_text(F.col("CDL")))
    return ST.count_by_class_year(dec)


@query("a04_series_summary", "A04 L01 T12 T13 T14 T36 A17 X01 X02 D8", sql=Q.with_(Q.OBS) + """
SELECT bbox, year, pixel_id, CDL, count(*) AS num_images,
       strftime(min(scene_date), '%Y-%m-%d') AS first_date,
       strftime(max(scene_date), '%Y-%m-%d') AS last_date,
       CAST(date_diff('day', min(scene_date), max(scene_date)) AS INTEGER) AS last_day,
       string_agg(strftime(scene_date, '%Y-%m-%d'), ',' ORDER BY scene_date, tile) AS img_dates,
       string_agg(tile, ',' ORDER BY scene_date, tile) AS tiles,
       string_agg(CAST(scl AS VARCHAR), ',' ORDER BY scene_date, tile) AS scl_vals
FROM obs GROUP BY bbox, year, pixel_id, CDL""")
def a04_series_summary(spark, sf):
    return S.series_summary(series(spark, sf))


ENCODED_SQL = Q.with_(Q.OBS) + f""",
o AS (SELECT *, row_number() OVER (PARTITION BY bbox, year, pixel_id, CDL ORDER BY scene_date, tile) AS i FROM obs)
SELECT bbox, year, pixel_id, hex(encode(CDL)) AS cdl_hex, count(*) AS num_images,
       string_agg({' || '.join(f"printf('%04X', {b})" for b in K.BANDS)}, '' ORDER BY i) AS bands_hex,
       string_agg(tile, ',' ORDER BY i) AS tiles,
       string_agg(printf('%04X', CAST(date_diff('day', DATE '1970-01-01', scene_date) AS INTEGER)), '' ORDER BY i) AS img_dates_hex,
       string_agg(printf('%02X', scl), '' ORDER BY i) AS scl_vals_hex
FROM o GROUP BY bbox, year, pixel_id, CDL"""


def encoded_text(enc: DataFrame) -> DataFrame:
    """An encoded series with its binary columns as hex text."""
    return enc.select("bbox", "year", "pixel_id", F.hex("CDL").alias("cdl_hex"), "num_images",
                      F.hex("bands").alias("bands_hex"), codec.decode_text(F.col("tiles")).alias("tiles"),
                      F.hex("img_dates").alias("img_dates_hex"), F.hex("scl_vals").alias("scl_vals_hex"))


@query("t15_encoded_series", "T15 T16 T17 T18 X03 X04 D9 Q22 Q23", sql=ENCODED_SQL)
def t15_encoded_series(spark, sf):
    return encoded_text(S.encode_series(series(spark, sf)))


@query("t23_decoded_series", "T19 T20 T21 T22 T23 W08 T39 X06 X08 D10", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, CDL,
       CAST(row_number() OVER (PARTITION BY bbox, year, pixel_id, CDL ORDER BY scene_date, tile) - 1 AS INTEGER) AS image_index,
       scene_date, tile, scl, {Q.BAND_LIST}
FROM obs""")
def t23_decoded_series(spark, sf):
    dec = S.decode_series(S.encode_series(series(spark, sf)))
    return S.explode_images(dec)


@query("t24_ndvi", "T24 T26 X05 F05", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, scene_date, tile, CDL,
       round(CAST({Q.NIR} - {Q.RED} AS DOUBLE) / nullif(CAST({Q.NIR} + {Q.RED} AS DOUBLE), 0), 6) AS ndvi,
       {Q.NDVI100} AS ndvi100
FROM obs""")
def t24_ndvi(spark, sf):
    obs = observations(spark, sf)
    return obs.select("bbox", "year", "pixel_id", "scene_date", "tile", "CDL",
                      F.round(ndvi("red", "nir"), 6).alias("ndvi"), ndvi_percent("red", "nir").alias("ndvi100"))


@query("t25_series_ndvi", "T25 X07 Q7", sql=Q.with_(Q.OBS) + f""",
o AS (SELECT *, row_number() OVER (PARTITION BY bbox, year, pixel_id, CDL ORDER BY scene_date, tile) - 1 AS i FROM obs)
SELECT bbox, year, pixel_id, count(*) AS n_images,
       count(*) FILTER (WHERE {Q.NIR} + {Q.RED} <> 0) AS n_ndvi,
       round(avg(CAST({Q.NIR} - {Q.RED} AS DOUBLE) / nullif(CAST({Q.NIR} + {Q.RED} AS DOUBLE), 0)), 6) AS mean_ndvi,
       round(max(CAST({Q.NIR} - {Q.RED} AS DOUBLE) / nullif(CAST({Q.NIR} + {Q.RED} AS DOUBLE), 0)), 6) AS max_ndvi
FROM o GROUP BY bbox, year, pixel_id""")
def t25_series_ndvi(spark, sf):
    dec = S.decode_series(S.encode_series(series(spark, sf)))
    kept = S.with_series_ndvi(dec, drop_zero_sum=True)
    return kept.select("bbox", "year", "pixel_id", F.col("num_images").alias("n_images"),
                       F.size("ndvi").cast("bigint").alias("n_ndvi"),
                       F.round(F.aggregate("ndvi", F.lit(0.0), lambda a, v: a + v) / F.size("ndvi"), 6).alias("mean_ndvi"),
                       F.round(F.array_max("ndvi"), 6).alias("max_ndvi"))


@query("f05_point_lookup", "F05 F17 T19", sql=Q.with_(Q.OBS) + f"""
SELECT pixel_id, year, CDL, scene_date, tile, scl, {Q.NDVI100} AS ndvi100
FROM obs WHERE pixel_id = 3 AND year = 1998 AND CDL = 'Cotton'""")
def f05_point_lookup(spark, sf):
    obs = observations(spark, sf)
    enc = obs.withColumn("cdl_bytes", codec.encode_text(F.col("CDL")))
    hit = enc.where((F.col("pixel_id") == 3) & (F.col("year") == 1998) & (F.col("cdl_bytes") == F.lit("Cotton").cast("binary")))
    return hit.select("pixel_id", "year", "CDL", "scene_date", "tile", "scl", ndvi_percent("red", "nir").alias("ndvi100"))


@query("a20_series_any_all", "A20 F19 J11", sql=Q.with_(Q.OBS) + """
SELECT bbox, year, pixel_id,
       bool_or(scl = 4) AS any_vegetation, bool_and(scl <> 0) AS all_valid,
       CDL IN ('Soybeans', 'Rice', 'Corn', 'Cotton') AS is_target
FROM obs GROUP BY bbox, year, pixel_id, CDL""")
def a20_series_any_all(spark, sf):
    s = series(spark, sf)
    scl = F.transform("images", lambda x: x["scl"])
    return s.select("bbox", "year", "pixel_id",
                    F.exists(scl, lambda v: v == K.SCL_VEGETATION).alias("any_vegetation"),
                    F.forall(scl, lambda v: v != 0).alias("all_valid"),
                    F.col("CDL").isin(K.TARGET_CROPS).alias("is_target"))


# ---------------------------------------------------------------- step 3: loader

_LONG_COLS = ["bbox", "year", "pixel_id", "CDL", "start_day", "label", "slot", "day", "ndvi", "scl", *K.BANDS]


@query("l09_train_slots", "L08 L09 F18 W04 W05 W06 W09 T28 T29 W07 F09 F19 T40 T41 J06 A20 X09 D11 D12",
       sql=Q.with_(Q.TRAIN) + f"SELECT {', '.join(_LONG_COLS)} FROM train_long")
def l09_train_slots(spark, sf):
    return L.slots_long(train_examples(spark, sf)).select(*_LONG_COLS)


@query("j07_sweep_slots", "J07 W10 F18 W04 W09 T28 T29 Q8 Q9 Q10 Q11 Q25",
       sql=Q.with_(Q.SWEEP) + f"SELECT {', '.join(_LONG_COLS)} FROM sweep_long")
def j07_sweep_slots(spark, sf):
    return L.slots_long(sweep(spark, sf)).select(*_LONG_COLS)


@query("t31_normalised_features", "T31 T32 F16 M06 T30", sql=Q.with_(Q.TRAIN) + ", nb AS (SELECT * FROM train_long)\nSELECT bbox, year, pixel_id, slot, label, "
       + ", ".join(f"round(CASE WHEN {b} = 0 THEN 0.0 ELSE (CAST({b} AS DOUBLE) - {m!r}) / {s!r} END, 6) AS z_{b}"
                   for b, m, s in zip(K.BANDS, K.BAND_MEANS, K.BAND_STDS))
       + "".join(f", CAST(label = {i} AS INTEGER) AS is_{i}" for i in range(K.NUM_CLASSES)) + " FROM nb")
def t31_normalised_features(spark, sf):
    ex = L.with_one_hot(train_examples(spark, sf))
    long = ex.select("bbox", "year", "pixel_id", "label", "label_one_hot", F.explode_outer("slots").alias("s"))
    z = L.normalise_bands(F.col("s.bands"))
    return long.select("bbox", "year", "pixel_id", F.col("s.slot").alias("slot"), "label",
                       *[F.round(z[i], 6).alias(f"z_{b}") for i, b in enumerate(K.BANDS)],
                       *[F.col("label_one_hot")[i].cast("int").alias(f"is_{i}") for i in range(K.NUM_CLASSES)])


@query("m06_fit_normaliser", "M06 A08 A09 Q18", sql=Q.with_(Q.TRAIN) + """,
stacked AS (""" + " UNION ALL ".join(
    f"SELECT {i} AS band_index, '{b}' AS band, {b} AS v FROM train_long" for i, b in enumerate(K.BANDS)) + """)
SELECT band_index, band, round(avg(CAST(v AS DOUBLE)) FILTER (WHERE v <> 0), 6) AS mean,
       round(stddev_pop(CAST(v AS DOUBLE)) FILTER (WHERE v <> 0), 6) AS std
FROM stacked GROUP BY band_index, band""")
def m06_fit_normaliser(spark, sf):
    n = L.fit_normaliser(L.slots_long(train_examples(spark, sf)))
    return n.select("band_index", "band", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("a10_label_histogram", "A10 Q20 Q21", sql=Q.with_(Q.TRAIN) + """,
lab AS (SELECT DISTINCT bbox, year, pixel_id, CDL, start_day, label FROM train_long),
legend AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{n}')" for i, n in enumerate(K.LABEL_LEGEND)) + """) AS t(label, label_name))
SELECT g.label, g.label_name, CAST(count(l.label) AS BIGINT) AS count
FROM legend g LEFT JOIN lab l USING (label) GROUP BY g.label, g.label_name""")
def a10_label_histogram(spark, sf):
    return ST.label_histogram(train_examples(spark, sf)).select(
        F.col("label").cast("int").alias("label"), "label_name", "count")


@query("m07_split_leakage", "M07 S12 U02 U03 U04", sql=Q.with_(Q.OBS) + f""",
splits AS (
  SELECT DISTINCT CASE year WHEN {K.FIXTURE_SPLIT_YEARS['train']} THEN 'train' WHEN {K.FIXTURE_SPLIT_YEARS['validation']} THEN 'validation'
                   WHEN {K.FIXTURE_SPLIT_YEARS['test']} THEN 'test' END AS split, year, pixel_id FROM obs),
known AS (SELECT * FROM splits WHERE split IS NOT NULL)
SELECT pixel_id, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(*) AS n_series FROM known GROUP BY pixel_id
HAVING count(DISTINCT split) > 1""")
def m07_split_leakage(spark, sf):
    """Pixels that more than one split has, whatever the year: one scan, one aggregation."""
    keys = L.split_keys(observations(spark, sf), K.FIXTURE_SPLIT_YEARS)
    n = F.size("splits").cast("bigint").alias("n_series")  # one series for each split, as splits are years
    return L.leakage(keys).select("pixel_id", F.array_join("splits", ",").alias("splits"), n)


@query("a16_band_distribution", "A16 F14 F15", sql=Q.with_(Q.TRAIN) + """,
rows_ AS (SELECT DISTINCT """ + ", ".join(K.BANDS) + """ FROM train_long),
nz AS (SELECT * FROM rows_ WHERE """ + " AND ".join(f"{b} <> 0" for b in K.BANDS) + """),
stacked AS (""" + " UNION ALL ".join(f"SELECT '{b}' AS band, CAST({b} AS DOUBLE) AS v FROM nz" for b in K.BANDS) + """)
SELECT band, count(v) AS n, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean,
       round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75,
""" + ",\n".join(f"  count(*) FILTER (WHERE v >= {b * 1000.0} AND v {'<' if b < 9 else '<='} {(b + 1) * 1000.0}) AS h{b}" for b in range(10))
       + ",\n  count(*) FILTER (WHERE v < 0) AS h_under, count(*) FILTER (WHERE v > 10000) AS h_over\nFROM stacked GROUP BY band")
def a16_band_distribution(spark, sf):
    long = L.slots_long(train_examples(spark, sf)).select(*K.BANDS).dropDuplicates()
    nz = long.where(F.forall(F.array(*K.BANDS), lambda v: v != 0))
    return ST.band_distribution(nz, K.BANDS, exact=True)


@query("l04_first_examples", "L04 L05 S17", sql=Q.with_(Q.TRAIN) + """
SELECT DISTINCT bbox, year, pixel_id, CDL, start_day, label FROM train_long
ORDER BY year, pixel_id LIMIT 9""")
def l04_first_examples(spark, sf):
    ex = train_examples(spark, sf).select("bbox", "year", "pixel_id", "CDL", "start_day", "label")
    return ex.orderBy("year", "pixel_id").limit(9)


# ---------------------------------------------------------------- step 4: scenes

@query("w03_keep_latest_scenes", "W03 T08 T09 T10 Q13", sql=Q.with_(Q.SCENES) + """,
keyed AS (
  SELECT scene_id, split_part(scene_id, '_', 2) AS mgrs,
         split_part(scene_id, '_', 2) || '_' || split_part(scene_id, '_', -2) AS tile,
         regexp_extract(scene_id, '^(.*)_[^_]*_[^_]*$', 1) AS base_id,
         CAST(split_part(scene_id, '_', -2) AS INTEGER) AS seq,
         CAST(substr(datetime, 1, 10) AS DATE) AS scene_date
  FROM scenes)
SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY base_id ORDER BY seq DESC, scene_id DESC) = 1""")
def w03_keep_latest_scenes(spark, sf):
    s = SC.scene_keys(FX.scenes(spark, sf))
    return SC.keep_latest(s).select("scene_id", "mgrs", "tile", "base_id", "seq", "scene_date")


@query("f08_usable_scenes", "F08 A06 Q15", sql=Q.with_(Q.SCENES) + """
SELECT scene_id, vegetation_percentage + not_vegetated_percentage + thin_cirrus_percentage
       + cloud_shadow_percentage + dark_features_percentage AS usable_area
FROM scenes WHERE vegetation_percentage + not_vegetated_percentage + thin_cirrus_percentage
       + cloud_shadow_percentage + dark_features_percentage > 30.0""")
def f08_usable_scenes(spark, sf):
    return SC.usable_scenes(FX.scenes(spark, sf)).select("scene_id", "usable_area")


@query("s09_parse_catalog", "S09 T38 D5", sql=Q.with_(Q.SCENES) + """
SELECT scene_id, collection, datetime, vegetation_percentage, cloud_shadow_percentage, min_lon, min_lat,
       min_lon + CAST(1.2 AS DOUBLE) AS max_lon, min_lat + CAST(1.2 AS DOUBLE) AS max_lat,
       's3://scenes/' || scene_id || '/scl.tif' AS href_scl, 's3://scenes/' || scene_id || '/nir.tif' AS href_nir
FROM scenes""")
def s09_parse_catalog(spark, sf):
    from cropcube.session import shared_path
    pages = shared_path(spark, "catalog-pages")
    FX.scene_json(spark, sf).write.mode("overwrite").text(pages)  # one JSON-lines page per task
    p = SC.read_scene_catalog(spark, pages)
    return p.select("scene_id", "collection", "datetime", "vegetation_percentage", "cloud_shadow_percentage",
                    "min_lon", "min_lat", "max_lon", "max_lat", "href_scl", "href_nir")


@query("s09_event_props", "S09", sql="""
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def s09_event_props(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "event_type", "props"])
    return ev.select("event_id", "event_type", F.from_json("props", "k INT")["k"].alias("k"))


_AOI_ENV_SQL = "aoi_in AS (SELECT * FROM (VALUES " + ", ".join(f"('{b}')" for b in K.AOI_BBOXES) + """) AS t(bbox)),
aoi_p AS (
  SELECT bbox, CAST(string_split(bbox, ', ')[1] AS BIGINT) AS l, CAST(string_split(bbox, ', ')[2] AS BIGINT) AS b,
         CAST(string_split(bbox, ', ')[3] AS BIGINT) AS r, CAST(string_split(bbox, ', ')[4] AS BIGINT) AS t FROM aoi_in),
corners AS (
  SELECT bbox, l AS cx, b AS cy FROM aoi_p UNION ALL SELECT bbox, r, b FROM aoi_p
  UNION ALL SELECT bbox, r, t FROM aoi_p UNION ALL SELECT bbox, l, t FROM aoi_p),
corner_ll AS (SELECT * FROM """ + Q.albers_inverse("corners", "cx", "cy", digits=None) + """),
aoi_env AS (SELECT bbox, min(lon) AS a_min_lon, min(lat) AS a_min_lat, max(lon) AS a_max_lon, max(lat) AS a_max_lat
            FROM corner_ll GROUP BY bbox)"""


@query("j05_scene_search", "J05 F12 T11 T01 T02 J02 J12", sql=Q.with_(Q.SCENES) + ",\n" + _AOI_ENV_SQL + """,
aoi_year AS (SELECT * FROM aoi_env CROSS JOIN (VALUES """ + ", ".join(f"({y})" for y in FX.RASTER_YEARS) + """) AS y(year))
SELECT a.bbox, a.year, s.scene_id
FROM scenes_full s JOIN aoi_year a
  ON s.min_lon <= a.a_max_lon AND a.a_min_lon <= s.max_lon AND s.min_lat <= a.a_max_lat AND a.a_min_lat <= s.max_lat
 AND CAST(substr(s.datetime, 1, 10) AS DATE) >= make_date(a.year, 1, 1)
 AND CAST(substr(s.datetime, 1, 10) AS DATE) < make_date(a.year + 1, 1, 1)
WHERE s.collection = 'sentinel-2-l2a'""")
def j05_scene_search(spark, sf):
    aois = SC.aoi_frame(spark, years=FX.RASTER_YEARS)
    hits = SC.search(FX.scenes(spark, sf), aois)
    return hits.select("bbox", "year", "scene_id")


def _meets(a: str, b: str) -> str:
    """Separating axes in SQL over two rings (lists of x, y)."""
    def axes(r):
        return f"list_transform(range(1, 5), lambda i: {{'x': {r}[i].y - {r}[i % 4 + 1].y, 'y': {r}[i % 4 + 1].x - {r}[i].x}})"
    reach = lambda r: f"list_transform({r}, lambda p: p.x * n.x + p.y * n.y)"
    apart = f"list_min({reach(a)}) > list_max({reach(b)}) OR list_min({reach(b)}) > list_max({reach(a)})"
    return f"len(list_filter(list_concat({axes(a)}, {axes(b)}), lambda n: {apart})) = 0"


_POINTS = [("min_lon + t", "min_lat"), ("max_lon", "min_lat + t"), ("max_lon - t", "max_lat"), ("min_lon", "max_lat - t")]


@query("j05_footprint_search", "J05 F12 J02 T01", sql=Q.with_(Q.SCENES) + ",\n" + _AOI_ENV_SQL.replace(
    "SELECT bbox, l AS cx, b AS cy FROM", "SELECT bbox, 0 AS k, l AS cx, b AS cy FROM").replace(
    "SELECT bbox, r, b FROM", "SELECT bbox, 1, r, b FROM").replace("SELECT bbox, r, t FROM", "SELECT bbox, 2, r, t FROM").replace(
    "SELECT bbox, l, t FROM", "SELECT bbox, 3, l, t FROM") + """,
areas AS (
  SELECT bbox, y.year, list({'x': lon, 'y': lat} ORDER BY k) AS area FROM corner_ll
  CROSS JOIN (VALUES """ + ", ".join(f"({y})" for y in FX.RASTER_YEARS) + """) AS y(year) GROUP BY bbox, y.year),
turned AS (SELECT *, CAST(0.1 AS DOUBLE) + CAST(0.1 AS DOUBLE) * CAST(CAST(split_part(scene_id, '_', -2) AS INTEGER) % 4 AS DOUBLE) AS t FROM scenes_full),
rings AS (SELECT scene_id, collection, CAST(substr(datetime, 1, 4) AS INTEGER) AS year, [""" + ", ".join(
    f"{{'x': {x}, 'y': {y}}}" for x, y in _POINTS) + """] AS footprint FROM turned)
SELECT bbox, year, scene_id FROM rings JOIN areas USING (year)
WHERE collection = 'sentinel-2-l2a' AND """ + _meets("footprint", "area"))
def j05_footprint_search(spark, sf):
    """Scenes of three years whose turned footprint meets an area, by separating axes."""
    hits = SC.search_footprints(FX.scene_footprints(spark, sf), SC.aoi_rings(spark, years=FX.RASTER_YEARS))
    return hits.select("bbox", "year", "scene_id")


@query("j03_skip_existing", "J03 A07 A18 U01 U04 D15", sql=Q.with_(Q.OBS) + """,
cand AS (SELECT DISTINCT bbox, year, tile, scene_date FROM obs),
done AS (SELECT DISTINCT bbox, year, tile, scene_date FROM obs WHERE month(scene_date) <= 6),
pending AS (SELECT * FROM cand ANTI JOIN done USING (bbox, year, tile, scene_date)),
dates AS (SELECT bbox, year, tile, string_agg(strftime(scene_date, '%Y-%m-%d'), ',' ORDER BY scene_date) AS done_dates
          FROM done GROUP BY bbox, year, tile),
todo AS (SELECT DISTINCT bbox, year FROM cand EXCEPT SELECT DISTINCT bbox, year FROM done)
SELECT p.bbox, p.year, p.tile, p.scene_date, d.done_dates,
       (SELECT count(*) FROM todo t WHERE t.bbox = p.bbox AND t.year = p.year) > 0 AS partition_pending
FROM pending p LEFT JOIN dates d USING (bbox, year, tile)""")
def j03_skip_existing(spark, sf):
    obs = observations(spark, sf)
    cand = obs.select("bbox", "year", "tile", "scene_date").distinct()
    done = obs.where(F.month("scene_date") <= 6).select("bbox", "year", "tile", "scene_date")
    pending = SC.skip_existing(cand, done)
    dates = SC.existing_dates(done).select(
        "bbox", "year", "tile", F.array_join(F.transform("dates", lambda d: F.date_format(d, "yyyy-MM-dd")), ",").alias("done_dates"))
    todo = SC.pending_partitions(cand, done).withColumn("partition_pending", F.lit(True))
    return (pending.join(dates, ["bbox", "year", "tile"], "left")
            .join(todo, ["bbox", "year"], "left")
            .select("bbox", "year", "tile", "scene_date", "done_dates",
                    F.coalesce("partition_pending", F.lit(False)).alias("partition_pending")))


@query("l11_pick_tile", "L11 Q14 A18", sql=Q.with_(Q.SCENES) + f""",
chosen AS (SELECT mgrs FROM (SELECT DISTINCT mgrs FROM scn) ORDER BY {draw_sql("'tile'", 'mgrs')}, mgrs LIMIT 1)
SELECT scene_id FROM scenes WHERE split_part(scene_id, '_', 2) IN (SELECT mgrs FROM chosen)""")
def l11_pick_tile(spark, sf):
    s = SC.scene_keys(FX.scenes(spark, sf))
    return SC.pick_tile(s, seed=0).select("scene_id")


# ---------------------------------------------------------------- step 6: evaluation

@query("m05_predictions", "M03 M05 T33 T34 J07 D14 F20", sql=Q.with_(PRED_SQL) + """
SELECT bbox, year, pixel_id, raw_cdl, start_day, lat AS latitude, lon AS longitude, true_label, prediction,
       prediction_day, prediction_date FROM results_ll""")
def m05_predictions(spark, sf):
    return predictions(spark, sf)


@query("a11_accuracy", "A11", sql=Q.with_(PRED_SQL) + """
SELECT year, count(*) AS n, round(avg(CAST(true_label = prediction AS INTEGER)), 6) AS accuracy FROM results GROUP BY year""")
def a11_accuracy(spark, sf):
    return EV.accuracy(predictions(spark, sf), by=("year",))


@query("a12_confusion_matrix", "A12 J10", sql=Q.with_(PRED_SQL) + """,
grid AS (SELECT CAST(t AS INTEGER) AS true_label, CAST(p AS INTEGER) AS predicted FROM range(7) a(t), range(7) b(p)),
counts AS (SELECT true_label, prediction AS predicted, count(*) AS count FROM results GROUP BY true_label, prediction),
full_ AS (SELECT g.true_label, g.predicted, CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM grid g LEFT JOIN counts c USING (true_label, predicted))
SELECT true_label, predicted, count,
       round(CAST(count AS DOUBLE) / nullif(CAST(sum(count) OVER (PARTITION BY predicted) AS DOUBLE), 0), 6) AS share,
       """ + "CASE true_label " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(K.LABEL_LEGEND)) + " END AS true_name FROM full_")
def a12_confusion_matrix(spark, sf):
    cm = EV.confusion_matrix(predictions(spark, sf), "pred")
    return cm.select("true_label", "predicted", "count", "share", legend_name(F.col("true_label")).alias("true_name"))


@query("a15_accuracy_by_date", "A15 T34 Q19", sql=Q.with_(PRED_SQL) + """
SELECT prediction_date, count(*) AS n, round(avg(CAST(true_label = prediction AS INTEGER)), 6) AS accuracy
FROM results GROUP BY prediction_date""")
def a15_accuracy_by_date(spark, sf):
    return EV.accuracy(predictions(spark, sf), by=("prediction_date",))


@query("f13_one_start_day", "F13 T07", sql=Q.with_(PRED_SQL) + """
SELECT pixel_id, year, true_label, prediction,
       round(6378137.0 * radians(lon), 3) AS x_3857,
       round(6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2)), 3) AS y_3857
FROM results_ll WHERE start_day = 45""")
def f13_one_start_day(spark, sf):
    p = predictions(spark, sf).where(F.col("start_day") == 45)
    wm = geo.lonlat_to_web_mercator("longitude", "latitude")
    return p.select("pixel_id", "year", "true_label", "prediction",
                    F.round(wm["x"], 3).alias("x_3857"), F.round(wm["y"], 3).alias("y_3857"))


@query("j10_scl_names", "J10", sql=Q.with_(Q.OBS) + """
SELECT scl, CASE scl """ + " ".join(f"WHEN {k} THEN '{v}'" for k, v in K.SCL_NAMES.items()) + """ END AS scl_name, count(*) AS n
FROM obs_all GROUP BY scl""")
def j10_scl_names(spark, sf):
    obs = FX.observations(spark, sf, quality_filter=False)
    return obs.groupBy("scl").agg(F.count("*").alias("n")).select("scl", scl_name(F.col("scl")).alias("scl_name"), "n")


# ---------------------------------------------------------------- step 5: scenes x pixels

@query("j04_observe_scenes", "J04 T06 J12 F03 F06 F07 D6 Q24", sql=Q.with_(Q.RAW_OBS) + f""",
attrs AS (
  SELECT *, {Q.AOI_LIST}[CAST(pixel_id % 7 AS INTEGER) + 1] AS bbox, {Q.class_case('pixel_id % 12')} AS CDL,
         mgrs || '_' || CAST(seq AS VARCHAR) AS tile,
         {FX.PIXEL_X_SQL} AS gx,
         {FX.PIXEL_Y_SQL} AS gy,
         CAST(-92.0 AS DOUBLE) + CAST(ascii(substr(mgrs, 1, 1)) % 3 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS fmin_lon,
         CAST(34.0 AS DOUBLE) + CAST(ascii(substr(mgrs, 2, 1)) % 2 AS DOUBLE) * CAST(1.1 AS DOUBLE) AS fmin_lat
  FROM raw_obs),
located AS (SELECT * FROM {Q.albers_inverse('attrs', 'gx', 'gy')})
SELECT bbox, year, pixel_id, CDL, scene_date, tile, scl, {Q.BAND_LIST}
FROM located
WHERE scl NOT IN ({Q.SCL_EXCLUDE}) AND CDL IS NOT NULL
  AND lon >= fmin_lon AND lon <= fmin_lon + CAST(1.2 AS DOUBLE) AND lat >= fmin_lat AND lat <= fmin_lat + CAST(1.2 AS DOUBLE)""")
def j04_observe_scenes(spark, sf):
    """Samples of all scenes, from stored blocks of cells."""
    smp = FX.samples_from_observations(spark, sf)
    smp = smp.select("*", F.inline_outer(F.array(FX.pixel_lonlat("pixel_id"))))
    tiles = FX.scenes(spark, sf).select(
        F.year(F.to_date(F.substring("datetime", 1, 10))).alias("year"),
        F.element_at(F.split("scene_id", "_"), 2).alias("mgrs"),
        "min_lon", "min_lat", "max_lon", "max_lat").distinct()
    cells = OB.sample_cells(smp, tiles, FX.scene_cell)
    obs = BL.observe_blocks(cells, BL.write_blocks(FX.scene_blocks(spark, sf)))
    obs = OB.quality_filter(obs.withColumn("tile", F.concat_ws("_", "mgrs", F.col("seq").cast("string"))))
    return obs.select("bbox", "year", "pixel_id", "CDL", "scene_date", "tile", "scl", *K.BANDS)


_AF_X0 = 399960 + 20 * (ord("A") % 3)
_AF_Y0 = 4000020 - 20 * (ord("F") % 2)


@query("t06_utm_cells", "T06 T05 T07", sql=Q.with_(Q.RAW_OBS) + f""",
px AS (SELECT DISTINCT pixel_id FROM raw_obs),
grid AS (SELECT pixel_id, {FX.PIXEL_X_SQL} AS gx,
                {FX.PIXEL_Y_SQL} AS gy FROM px),
ll AS (SELECT pixel_id, lon, lat FROM {Q.albers_inverse('grid', 'gx', 'gy')}),
u AS (SELECT * FROM {Q.utm_forward('ll', 'lon', 'lat', FX.UTM_ZONE)})
SELECT pixel_id, lon, lat, round(utm_x, 3) AS utm_x, round(utm_y, 3) AS utm_y,
       CAST(floor(({_AF_Y0}.0 - utm_y) / {FX.SCENE_CELL}) AS INTEGER) AS row,
       CAST(floor((utm_x - {_AF_X0}.0) / {FX.SCENE_CELL}) AS INTEGER) AS col
FROM u""")
def t06_utm_cells(spark, sf):
    """Sample pixels: lon/lat, UTM zone 15 metres and the 10 m scene cell per tile grid."""
    smp = FX.samples_from_observations(spark, sf).select("pixel_id").distinct()
    ll = FX.pixel_lonlat(F.col("pixel_id"))
    u = geo.lonlat_to_utm(ll["lon"], ll["lat"], F.lit(FX.UTM_ZONE))
    cell = FX.scene_cell(ll["lon"], ll["lat"], F.lit("AF"))
    return smp.select("pixel_id", ll["lon"].alias("lon"), ll["lat"].alias("lat"),
                      F.round(u["x"], 3).alias("utm_x"), F.round(u["y"], 3).alias("utm_y"),
                      cell["row"].alias("row"), cell["col"].alias("col"))


@query("l06_hash_sample", "L06", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, scene_date, tile FROM obs
WHERE {draw_sql("'sample'", 'pixel_id', 'scene_date', 'tile')} < {int(0.05 * 2 ** 32)}""")
def l06_hash_sample(spark, sf):
    """5 % of the observations, by the draw of their key."""
    return hash_sample(observations(spark, sf), ("pixel_id", "scene_date", "tile"), 0.05) \
        .select("bbox", "year", "pixel_id", "scene_date", "tile")


@query("l06_bernoulli_sample", "L06", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, CDL, scene_date, tile, scl, {Q.BAND_LIST} FROM obs
WHERE {draw_sql("'sample'", 'pixel_id', 'scene_date', 'tile', seed=42)} < {int(0.01 * 2 ** 32)}""")
def l06_bernoulli_sample(spark, sf):
    """Seeded 1 % Bernoulli sample of the observations: each is in or out by its own draw."""
    return hash_sample(observations(spark, sf), ("pixel_id", "scene_date", "tile"), 0.01, seed=42) \
        .select("bbox", "year", "pixel_id", "CDL", "scene_date", "tile", "scl", *K.BANDS)


@query("f07_rejected_rows", "F06 F07 Q17 Q16", sql=Q.with_(Q.OBS) + f"""
SELECT bbox, year, pixel_id, scene_date, tile, scl,
       CASE WHEN scl IN ({Q.SCL_EXCLUDE}) THEN 'scl excluded: ' || CAST(scl AS VARCHAR)
            WHEN CDL IS NULL THEN 'class not in dictionary' END AS reason
FROM obs_all WHERE scl IN ({Q.SCL_EXCLUDE}) OR CDL IS NULL""")
def f07_rejected_rows(spark, sf):
    obs = FX.observations(spark, sf, quality_filter=False)
    return OB.rejected_rows(obs).select("bbox", "year", "pixel_id", "scene_date", "tile", "scl", "reason")


@query("l05_nth_example", "L05 S17", sql=Q.with_(Q.TRAIN) + """
SELECT DISTINCT bbox, year, pixel_id, CDL, start_day, label FROM train_long
ORDER BY year, pixel_id LIMIT 1 OFFSET 4""")
def l05_nth_example(spark, sf):
    """The 5th example in key order (``offset`` + ``limit``), as a notebook would peek at one row."""
    ex = train_examples(spark, sf).select("bbox", "year", "pixel_id", "CDL", "start_day", "label")
    return ex.orderBy("year", "pixel_id").offset(4).limit(1)
