"""Pixel time series: assembly, byte encoding, decoding.

A series is one row per (area, year, pixel, class) with its images sorted by
(scene_date, tile).  Assembly is the only shuffle of the whole loader: a
``collect_list`` hash-partitioned on the series key.  Its groups are bounded
by construction: observations are first reduced to one per (pixel, scene
date, tile grid) (see ``observe.latest_per_key``), so a series holds at most
366 x (tile grids covering the pixel) images whatever the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions import codec
from cropcube.functions.hof import let, record
from cropcube.functions.indices import ndvi_percent, series_ndvi

SERIES_KEY = ("bbox", "year", "pixel_id", "CDL")
IMAGE_TYPE = "struct<scene_date:date,tile:string,scl:int,bands:array<int>>"


def image_struct(band_cols=K.BANDS) -> Column:
    """One image as struct<scene_date, tile, scl, bands array<int>>."""
    return F.expr(f"named_struct('scene_date', scene_date, 'tile', tile, 'scl', scl, 'bands', array({', '.join(band_cols)}))")


def build_series(obs: DataFrame, key=SERIES_KEY) -> DataFrame:
    """A04 + L01: group observations into date-sorted series with image count."""
    return obs.groupBy(*key).agg(
        F.array_sort(F.collect_list(image_struct())).alias("images"),
        F.count("*").alias("num_images"))


def series_summary(series: DataFrame, key=SERIES_KEY) -> DataFrame:
    """Text view of a series (T13, T14, T36, A17): dates, tiles, scl lists, span."""
    im = F.col("images")
    return series.select(
        *key, "num_images",
        F.date_format(im[0]["scene_date"], "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.element_at(im, -1)["scene_date"], "yyyy-MM-dd").alias("last_date"),
        F.datediff(F.element_at(im, -1)["scene_date"], im[0]["scene_date"]).alias("last_day"),
        F.array_join(F.transform(im, lambda x: F.date_format(x["scene_date"], "yyyy-MM-dd")), ",").alias("img_dates"),
        F.array_join(F.transform(im, lambda x: x["tile"]), ",").alias("tiles"),
        codec.ints_to_text(F.transform(im, lambda x: x["scl"])).alias("scl_vals"),
    )


def encode_series(series: DataFrame, key=("bbox", "year", "pixel_id")) -> DataFrame:
    """Pack a series into the compact byte layout.

    bands: u16 BE, 12 per image; img_dates: u16 days since 1970-01-01;
    scl_vals: u8; tiles: UTF-8 text joined by ','; CDL: UTF-8 bytes.
    """
    im = F.col("images")
    return series.select(
        *key,
        codec.encode_text(F.col("CDL")).alias("CDL"),
        "num_images",
        codec.pack_uint(F.flatten(F.transform(im, lambda x: x["bands"])), 2).alias("bands"),
        codec.encode_text(F.array_join(F.transform(im, lambda x: x["tile"]), ",")).alias("tiles"),
        codec.pack_dates(F.transform(im, lambda x: x["scene_date"])).alias("img_dates"),
        codec.pack_uint(F.transform(im, lambda x: x["scl"]), 1).alias("scl_vals"),
    )


def decode_series(encoded: DataFrame, key=("bbox", "year", "pixel_id")) -> DataFrame:
    """Bytes back to the struct series (inverse of ``encode_series``)."""
    n = F.col("num_images").cast("int")
    parts = F.struct(codec.unpack_matrix(F.col("bands"), n, len(K.BANDS)).alias("rows"),
                     codec.unpack_dates(F.col("img_dates")).alias("dates"),
                     codec.unpack_uint(F.col("scl_vals"), 1).alias("scls"),
                     F.split(codec.decode_text(F.col("tiles")), ",").alias("tiles"))
    images = let(parts, lambda p: F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: record(
        scene_date=p["dates"][i], tile=p["tiles"][i], scl=p["scls"][i], bands=p["rows"][i])))
    images = F.when(n == 0, F.array().cast(f"array<{IMAGE_TYPE}>")).otherwise(images)
    return encoded.select(*key, codec.decode_text(F.col("CDL")).alias("CDL"), "num_images", images.alias("images"))


def series_rows(images) -> Column:
    """Per image struct<bands, ndvi, scl, day, tile>.

    ``day`` counts days since the first image of the series; ``ndvi`` is
    NDVI x 100 truncated and clipped to +/-100.
    """
    im = F.col(images) if isinstance(images, str) else images
    return let(im, lambda arr: F.transform(arr, lambda x: record(
        bands=x["bands"],
        ndvi=ndvi_percent(x["bands"][K.RED_INDEX], x["bands"][K.NIR_INDEX]),
        scl=x["scl"],
        day=F.datediff(x["scene_date"], arr[0]["scene_date"]),
        tile=x["tile"])))


def with_series_ndvi(series: DataFrame, drop_zero_sum: bool = False) -> DataFrame:
    """NDVI of every image of a series (null in place or dropped)."""
    return series.withColumn("ndvi", series_ndvi(F.transform("images", lambda x: x["bands"]), drop_zero_sum))


def explode_images(series: DataFrame, key=SERIES_KEY) -> DataFrame:
    """W08 + T39: one row per image with its ordinal in the series."""
    return series.select(*key, F.posexplode_outer("images").alias("image_index", "img")).where("image_index IS NOT NULL").select(
        *key, F.col("image_index").cast("int").alias("image_index"), "img.scene_date", "img.tile", "img.scl",
        *[F.col("img.bands")[i].alias(b) for i, b in enumerate(K.BANDS)])
