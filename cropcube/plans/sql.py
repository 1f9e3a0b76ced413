"""DuckDB SQL fragments over the driver's table views.

These restate the fixture views (``sources.fixtures``) and the loader in
plain SQL with window functions instead of array lambdas, so each
registered query has an independently written oracle.
"""

from __future__ import annotations

from cropcube import constants as K
from cropcube.functions import geo
from cropcube.functions.draws import draw_sql
from cropcube.sources import fixtures as FX

AOI_LIST = "[" + ", ".join(f"'{b}'" for b in K.AOI_BBOXES) + "]"
BAND_LIST = ", ".join(K.BANDS)
RED, NIR = K.BANDS[K.RED_INDEX], K.BANDS[K.NIR_INDEX]
SCL_EXCLUDE = ", ".join(str(v) for v in K.SCL_EXCLUDE)


def class_case(code: str) -> str:
    whens = " ".join(f"WHEN {c} THEN '{n}'" for c, n in FX.FIXTURE_CLASSES.items())
    return f"(CASE {code} {whens} END)"


def band_exprs() -> str:
    return ",\n         ".join(
        f"CAST((l_orderkey * {a} + l_partkey * {b} + l_linenumber * {c}) % 10000 AS INTEGER) AS {n}"
        for n, (a, b, c) in zip(K.BANDS, FX.BAND_MULTIPLIERS))


def albers_inverse(src: str, x: str, y: str, digits: int | None = 6, p: str = "") -> str:
    """Subquery over ``src`` adding {p}lon, {p}lat (EPSG:5070 -> 4326).

    One SELECT level per step so every intermediate is computed once (a
    single select with lateral aliases gets expanded exponentially).
    """
    n, c, rho0 = geo.ALBERS_N, geo.ALBERS_C, geo.ALBERS_RHO0
    a, e2 = geo._A, geo._E2
    e = e2 ** 0.5
    q = f"(SELECT *, CAST({x} AS DOUBLE) AS {p}_x, CAST({y} AS DOUBLE) AS {p}_y FROM {src})"
    q = (f"(SELECT *, sqrt({p}_x * {p}_x + ({rho0!r} - {p}_y) * ({rho0!r} - {p}_y)) AS {p}_rho, "
         f"atan2({p}_x, {rho0!r} - {p}_y) AS {p}_theta FROM {q})")
    q = f"(SELECT *, ({c!r} - {p}_rho * {p}_rho * {n * n / (a * a)!r}) / {n!r} AS {p}_q FROM {q})"
    q = f"(SELECT *, asin({p}_q / 2.0) AS {p}_phi0 FROM {q})"
    for i in range(1, geo.ALBERS_ITERATIONS + 1):
        ph = f"{p}_phi{i - 1}"
        q = (f"(SELECT *, {ph} + (1.0 - {e2!r} * sin({ph}) * sin({ph})) * (1.0 - {e2!r} * sin({ph}) * sin({ph})) "
             f"/ (2.0 * cos({ph})) * ({p}_q / {1 - e2!r} - sin({ph}) / (1.0 - {e2!r} * sin({ph}) * sin({ph})) "
             f"+ {1 / (2 * e)!r} * ln((1.0 - {e!r} * sin({ph})) / (1.0 + {e!r} * sin({ph})))) AS {p}_phi{i} FROM {q})")
    lon = f"degrees({geo._L0!r} + {p}_theta / {n!r})"
    lat = f"degrees({p}_phi{geo.ALBERS_ITERATIONS})"
    if digits is not None:
        lon, lat = f"round({lon}, {digits})", f"round({lat}, {digits})"
    drop = ", ".join([f"{p}_x", f"{p}_y", f"{p}_rho", f"{p}_theta", f"{p}_q"]
                     + [f"{p}_phi{i}" for i in range(geo.ALBERS_ITERATIONS + 1)])
    return f"(SELECT * EXCLUDE ({drop}), {lon} AS {p}lon, {lat} AS {p}lat FROM {q})"


def utm_forward(src: str, lon: str, lat: str, zone: int) -> str:
    """Subquery over ``src`` adding utm_x, utm_y (WGS84 UTM ``zone``, Krueger series)."""
    k = K.UTM_K0 * geo._UTM_A
    c = geo._TWO_SQRT_N
    lam0 = f"radians({zone * 6 - 183}.0)"
    q = (f"(SELECT *, radians({lat}) AS _phi, radians({lon}) - {lam0} AS _lam FROM {src})")
    q = f"(SELECT *, sinh(atanh(sin(_phi)) - {c!r} * atanh({c!r} * sin(_phi))) AS _t FROM {q})"
    q = f"(SELECT *, atan(_t / cos(_lam)) AS _xi, atanh(sin(_lam) / sqrt(1.0 + _t * _t)) AS _eta FROM {q})"
    e_sum = " + ".join(["_eta"] + [f"{a!r} * cos({2.0 * j!r} * _xi) * sinh({2.0 * j!r} * _eta)"
                                   for j, a in enumerate(geo._ALPHA, start=1)])
    n_sum = " + ".join(["_xi"] + [f"{a!r} * sin({2.0 * j!r} * _xi) * cosh({2.0 * j!r} * _eta)"
                                  for j, a in enumerate(geo._ALPHA, start=1)])
    north = f"CASE WHEN {lat} < 0 THEN {k!r} * ({n_sum}) + {K.UTM_FALSE_NORTHING_SOUTH!r} ELSE {k!r} * ({n_sum}) END"
    return (f"(SELECT * EXCLUDE (_phi, _lam, _t, _xi, _eta), {K.UTM_FALSE_EASTING!r} + {k!r} * ({e_sum}) AS utm_x, "
            f"{north} AS utm_y FROM {q})")


RAW_OBS = f"""raw_obs AS (
  SELECT l_suppkey AS pixel_id,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(l_shipdate AS DATE) AS scene_date,
         l_returnflag || l_linestatus AS mgrs,
         CAST(l_linenumber AS INTEGER) AS seq,
         CAST((l_orderkey + l_partkey) % 12 AS INTEGER) AS scl,
         {band_exprs()}
  FROM lineitem)"""

OBS = RAW_OBS + f""",
dedup AS (
  SELECT * FROM raw_obs
  QUALIFY row_number() OVER (PARTITION BY pixel_id, year, scene_date, mgrs
                             ORDER BY seq DESC, scl DESC, {', '.join(b + ' DESC' for b in K.BANDS)}) = 1),
obs_all AS (
  SELECT *, {AOI_LIST}[CAST(pixel_id % 7 AS INTEGER) + 1] AS bbox,
         CAST(pixel_id % 12 AS INTEGER) AS cdl_code,
         {class_case('pixel_id % 12')} AS CDL,
         mgrs || '_' || CAST(seq AS VARCHAR) AS tile
  FROM dedup),
obs AS (SELECT * FROM obs_all WHERE scl NOT IN ({SCL_EXCLUDE}) AND CDL IS NOT NULL)"""

NDVI100 = (f"greatest(-100, least(100, coalesce(CAST(trunc(CAST({NIR} - {RED} AS DOUBLE) "
           f"/ nullif(CAST({NIR} + {RED} AS DOUBLE), 0) * 100.0) AS INTEGER), 0)))")

# One row per image with the loader's per-image features.
SROWS = OBS + f""",
srows AS (
  SELECT bbox, year, pixel_id, CDL, scene_date, tile, scl, {BAND_LIST},
         {NDVI100} AS ndvi,
         CAST(date_diff('day', min(scene_date) OVER (PARTITION BY bbox, year, pixel_id, CDL), scene_date) AS INTEGER) AS day
  FROM obs)"""

SERIES_KEY = "bbox, year, pixel_id, CDL"
LABEL_BASE = ("(CASE " + " ".join(f"WHEN CDL = '{c}' THEN {i + 3}" for i, c in enumerate(K.TARGET_CROPS))
              + " WHEN CDL IN (" + ", ".join("'" + c.replace("'", "''") + "'" for c in K.OTHER_CULTIVATED)
              + ") THEN 1 ELSE 0 END)")
ZERO_BANDS = ", ".join(f"0 AS {b}" for b in K.BANDS)


def bucket_sql(win: str, key: str, out: str) -> str:
    """CTEs turning window rows ``win`` (key cols + day, tile, values) into slots ``out``.

    Days re-based on the first kept image, clipped to [0, 365], slot = day // 5,
    first image per slot; ``key`` must include every grouping column.
    """
    return f"""{out}_n AS (
  SELECT *, least({K.MAX_NORMALISED_DAY}, greatest(0, day - min(day) OVER (PARTITION BY {key}))) AS nd FROM {win}),
{out}_s AS (
  SELECT *, CAST(nd // {K.DAYS_PER_BUCKET} AS INTEGER) AS slot FROM {out}_n),
{out} AS (
  SELECT {key}, slot, CAST(nd AS INTEGER) AS day, ndvi, scl, {BAND_LIST} FROM {out}_s
  QUALIFY row_number() OVER (PARTITION BY {key}, slot ORDER BY day, tile) = 1)"""


def label_sql(slots: str, key: str, out: str) -> str:
    """CTEs computing the crop label per ``key`` from slot rows ``slots``."""
    return f"""{out}_nz AS (
  SELECT {key}, scl FROM {slots} WHERE scl <> 0
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY slot DESC) <= 2),
{out}_veg AS (
  SELECT {key}, count(*) FILTER (WHERE scl = {K.SCL_VEGETATION}) AS n_veg FROM {out}_nz GROUP BY {key}),
{out} AS (
  SELECT k.*, CAST(CASE WHEN {LABEL_BASE} <> 0 AND coalesce(v.n_veg, 0) = 0 THEN {K.LABEL_NO_CROP_GROWING}
                   ELSE {LABEL_BASE} END AS INTEGER) AS label
  FROM (SELECT DISTINCT {key} FROM {slots}) k LEFT JOIN {out}_veg v USING ({key}))"""


# Train loader: seeded window, seeded 25-image subsample, bucket, label.
TRAIN = SROWS + f""",
tr_series AS (
  SELECT {SERIES_KEY}, max(day) AS last_day FROM srows WHERE CDL NOT LIKE '%Dbl%' GROUP BY {SERIES_KEY}),
tr_start AS (
  SELECT *, CAST({draw_sql("'start'", *SERIES_KEY.split(', '))} % greatest(1, last_day - {K.DAYS_IN_SERIES}) AS INTEGER) AS start_day
  FROM tr_series),
tr_win_all AS (
  SELECT r.*, s.start_day FROM srows r JOIN tr_start s USING ({SERIES_KEY})
  WHERE r.day >= s.start_day AND r.day <= s.start_day + {K.DAYS_IN_SERIES}),
tr_win AS (
  SELECT * FROM tr_win_all
  QUALIFY row_number() OVER (PARTITION BY {SERIES_KEY}
      ORDER BY {draw_sql("'image'", *SERIES_KEY.split(', '), 'day', 'tile')}, day, tile) <= {K.MAX_IMAGES_PER_SERIES}),
{bucket_sql('tr_win', SERIES_KEY + ', start_day', 'tr_filled')},
tr_slots AS (
  SELECT * FROM tr_filled
  UNION ALL
  SELECT s.bbox, s.year, s.pixel_id, s.CDL, s.start_day, 0 AS slot, 0 AS day, 0 AS ndvi, 0 AS scl, {ZERO_BANDS}
  FROM tr_start s ANTI JOIN tr_win w USING ({SERIES_KEY})),
{label_sql('tr_slots', SERIES_KEY + ', start_day', 'tr_label')},
train_long AS (
  SELECT s.*, l.label FROM tr_slots s JOIN tr_label l USING ({SERIES_KEY}, start_day))"""

SWEEP_DAYS = ", ".join(f"({d})" for d in K.SWEEP_START_DAYS)

SWEEP = SROWS + f""",
sw_series AS (SELECT DISTINCT {SERIES_KEY} FROM srows),
sw_start AS (SELECT * FROM sw_series CROSS JOIN (VALUES {SWEEP_DAYS}) AS t(start_day)),
sw_win AS (
  SELECT r.*, s.start_day FROM srows r JOIN sw_start s USING ({SERIES_KEY})
  WHERE r.day >= s.start_day AND r.day <= s.start_day + {K.DAYS_IN_SERIES}),
{bucket_sql('sw_win', SERIES_KEY + ', start_day', 'sw_filled')},
sw_slots AS (
  SELECT * FROM sw_filled
  UNION ALL
  SELECT s.bbox, s.year, s.pixel_id, s.CDL, s.start_day, 0 AS slot, 0 AS day, 0 AS ndvi, 0 AS scl, {ZERO_BANDS}
  FROM sw_start s ANTI JOIN sw_win w USING ({SERIES_KEY}, start_day)),
{label_sql('sw_slots', SERIES_KEY + ', start_day', 'sw_label')},
sweep_long AS (
  SELECT s.*, l.label FROM sw_slots s JOIN sw_label l USING ({SERIES_KEY}, start_day))"""

RASTER_YEARS = ", ".join(f"({y})" for y in FX.RASTER_YEARS)

CELLS = f"""cells AS (
  SELECT CAST(p_partkey % 7 AS INTEGER) AS aoi, y.year,
         CAST((p_partkey // 7) // {FX.RASTER_WIDTH} AS INTEGER) AS row,
         CAST((p_partkey // 7) % {FX.RASTER_WIDTH} AS INTEGER) AS col,
         CAST((p_size + y.year) % 12 AS INTEGER) AS code
  FROM part CROSS JOIN (VALUES {RASTER_YEARS}) AS y(year)),
pixels AS (
  SELECT 'cdl_' || CAST(aoi AS VARCHAR) || '_' || CAST(year AS VARCHAR) AS raster_id,
         {AOI_LIST}[aoi + 1] AS bbox, year, row, col, code,
         CAST(string_split({AOI_LIST}[aoi + 1], ', ')[1] AS DOUBLE) AS x0,
         CAST(string_split({AOI_LIST}[aoi + 1], ', ')[4] AS DOUBLE) AS y0
  FROM cells)"""



def samples_sql(stride: int = K.STRIDE_DEFAULT) -> str:
    """CTEs of the systematic sample: every ``stride``-th row and column from a drawn start."""
    start = f"{draw_sql(chr(39) + 'grid' + chr(39), 'raster_id')} % {stride}"
    return CELLS + f""",
started AS (SELECT *, {start} AS start FROM pixels),
samples AS (
  SELECT * EXCLUDE (start), {class_case('code')} AS CDL FROM started
  WHERE row >= start AND (row - start) % {stride} = 0 AND col >= start AND (col - start) % {stride} = 0)"""


SAMPLES = samples_sql()

SCENES = f"""scn AS (
  SELECT DISTINCT l_returnflag || l_linestatus AS mgrs, CAST(l_shipdate AS DATE) AS scene_date,
         CAST(l_linenumber AS INTEGER) AS seq FROM lineitem),
scenes AS (
  SELECT 'S2A_' || mgrs || '_' || strftime(scene_date, '%Y%m%d') || '_' || CAST(seq AS VARCHAR) || '_L2A' AS scene_id,
         '{FX.SCENE_COLLECTION}' AS collection,
         strftime(scene_date, '%Y-%m-%d') || 'T16:45:00Z' AS datetime,
         {', '.join(f'CAST((dayofyear(scene_date) * {p} + seq * {q}) % 40 AS DOUBLE) AS {n}' for n, (p, q) in zip(K.USABLE_AREA_PROPERTIES, FX.PERCENT_PAIRS))},
         CAST(-92.0 AS DOUBLE) + CAST(ascii(substr(mgrs, 1, 1)) % 3 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS min_lon,
         CAST(34.0 AS DOUBLE) + CAST(ascii(substr(mgrs, 2, 1)) % 2 AS DOUBLE) * CAST(1.1 AS DOUBLE) AS min_lat
  FROM scn),
scenes_full AS (
  SELECT *, min_lon + CAST(1.2 AS DOUBLE) AS max_lon, min_lat + CAST(1.2 AS DOUBLE) AS max_lat FROM scenes)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
