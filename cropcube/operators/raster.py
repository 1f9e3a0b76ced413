"""Label rasters as tables: strips -> pixels -> samples.

A raster is held as strips, one row per raster row with an int array of
cell values.  ``posexplode`` turns a strip into cells inside the scan task,
so there is no shuffle until an aggregate; the systematic sample filters
rows *before* exploding, so only the kept rows are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropcube.functions import geo
from cropcube.functions.draws import draw


def seeded_start(key, stride: int | Column, seed: int = 0) -> Column:
    """Start offset in [0, stride - 1] of a raster, drawn from its key."""
    return (draw("grid", key, seed=seed) % F.lit(stride)).cast("int")


def raster_pixels(strips: DataFrame, row_filter=None, col_filter=None) -> DataFrame:
    """Strips -> one row per cell (raster_id, bbox, year, row, col, code, grid)."""
    s = strips if row_filter is None else strips.where(row_filter)
    cells = s.select("raster_id", "bbox", "year", "row", "x0", "y0", "dx", "dy",
                     F.posexplode("values").alias("col", "code"))
    cells = cells.withColumn("col", F.col("col").cast("int"))
    return cells if col_filter is None else cells.where(col_filter)


def grid_sample(strips: DataFrame, stride: int | Column, start=None, keep=()) -> DataFrame:
    """Every ``stride``-th row and column starting at ``start`` (same start for both axes).

    ``stride`` and ``start`` may be columns, for example where one scan takes samples of several
    strides; no start means the centre ``stride // 2``.  The columns are picked out of each
    strip before it is exploded, so only sampled cells become rows.  ``keep`` names further
    columns of the strips to carry.
    """
    step = F.lit(stride)
    s = F.floor(step / 2).cast("int") if start is None else F.lit(start)
    picked = strips.withColumn("_start", s).where((F.col("row") >= F.col("_start"))
                                                  & ((F.col("row") - F.col("_start")) % step == 0))
    last = F.size("values") - 1
    cols = F.when(F.col("_start") <= last, F.sequence(F.col("_start"), last, step)) \
        .otherwise(F.array().cast("array<int>"))
    cells = picked.select(*keep, "raster_id", "bbox", "year", "row", "x0", "y0", "dx", "dy", "values",
                          F.explode_outer(cols).alias("col")).where("col IS NOT NULL")
    return cells.withColumn("code", F.get("values", F.col("col"))).drop("values")


def crop_grid(pixels: DataFrame, n_rows: int = 800, n_cols: int = 800) -> DataFrame:
    """keep the first n_rows x n_cols cells."""
    return pixels.where((F.col("row") < n_rows) & (F.col("col") < n_cols))


def with_lonlat(pixels: DataFrame, digits: int | None = 6) -> DataFrame:
    """T04 + T05: cell centre in the raster CRS (EPSG:5070) -> lon/lat."""
    c = geo.cell_center("row", "col", "x0", "y0", "dx", "dy")
    ll = geo.albers_to_lonlat(c["x"], c["y"], digits)
    return pixels.withColumn("_ll", ll).withColumns({"lon": F.col("_ll.lon"), "lat": F.col("_ll.lat")}).drop("_ll")


def _per_strip(samples: DataFrame, value: str) -> DataFrame:
    """Samples as one map column -> value for each strip (raster, row)."""
    entry = F.struct(F.col("col").cast("int").alias("key"), F.col(value).alias("value"))
    return samples.groupBy("raster_id", "row").agg(F.map_from_entries(F.collect_set(entry)).alias("_at"))


def densify(strips: DataFrame, samples: DataFrame, value: str = "code") -> DataFrame:
    """Put sampled values back on the full grid, 0 where not sampled.

    Strips and samples meet strip by strip, not cell by cell: a sample map joins its
    strip, and the cells come out of the joined strip.
    """
    at = strips.select("raster_id", "row", F.size("values").alias("_n")) \
        .join(_per_strip(samples, value), ["raster_id", "row"], "left")
    cells = F.transform(F.sequence(F.lit(0), F.col("_n") - 1),
                        lambda i: F.coalesce(F.try_element_at(F.col("_at"), i), F.lit(0)))
    return at.where("_n > 0").select("raster_id", "row", F.posexplode_outer(cells).alias("col", value))


def samples_outside_grid(strips: DataFrame, samples: DataFrame) -> DataFrame:
    """Sampled cells that are not cells of the raster: no such strip, or beyond its end."""
    size = strips.select("raster_id", "row", F.size("values").alias("_n"))
    return samples.join(size, ["raster_id", "row"], "left") \
        .where(F.col("_n").isNull() | (F.col("col") < 0) | (F.col("col") >= F.col("_n"))).drop("_n")
