"""Explicit schemas of the logical tables (passed to readers, checked early)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BinaryType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

from cropcube import constants as K


def _bands() -> list[StructField]:
    return [StructField(b, IntegerType()) for b in K.BANDS]


CLASS_DICTIONARY = StructType([
    StructField("code", IntegerType()), StructField("class_name", StringType()),
    StructField("r", IntegerType()), StructField("g", IntegerType()), StructField("b", IntegerType())])

RASTER_STRIPS = StructType([
    StructField("raster_id", StringType()), StructField("bbox", StringType()), StructField("year", IntegerType()),
    StructField("row", IntegerType()), StructField("values", ArrayType(IntegerType())),
    StructField("x0", DoubleType()), StructField("y0", DoubleType()),
    StructField("dx", DoubleType()), StructField("dy", DoubleType())])

OBSERVATIONS = StructType([
    StructField("pixel_id", LongType()), StructField("year", IntegerType()), StructField("scene_date", DateType()),
    StructField("mgrs", StringType()), StructField("seq", IntegerType()), StructField("scl", IntegerType()),
    *_bands(), StructField("bbox", StringType()), StructField("CDL", StringType()), StructField("tile", StringType())])

IMAGE = StructType([
    StructField("scene_date", DateType()), StructField("tile", StringType()), StructField("scl", IntegerType()),
    StructField("bands", ArrayType(IntegerType()))])

SERIES = StructType([
    StructField("bbox", StringType()), StructField("year", IntegerType()), StructField("pixel_id", LongType()),
    StructField("CDL", StringType()), StructField("images", ArrayType(IMAGE)),
    StructField("num_images", LongType())])

SERIES_ENCODED = StructType([
    StructField("bbox", StringType()), StructField("year", IntegerType()), StructField("pixel_id", LongType()),
    StructField("CDL", BinaryType()), StructField("num_images", LongType()), StructField("bands", BinaryType()),
    StructField("tiles", BinaryType()), StructField("img_dates", BinaryType()), StructField("scl_vals", BinaryType())])

SCENES = StructType([
    StructField("scene_id", StringType()), StructField("collection", StringType()), StructField("datetime", StringType()),
    *[StructField(n, DoubleType()) for n in K.USABLE_AREA_PROPERTIES],
    StructField("min_lon", DoubleType()), StructField("min_lat", DoubleType()),
    StructField("max_lon", DoubleType()), StructField("max_lat", DoubleType())])

SLOTS_LONG = StructType([
    StructField("bbox", StringType()), StructField("year", IntegerType()), StructField("pixel_id", LongType()),
    StructField("CDL", StringType()), StructField("start_day", IntegerType()), StructField("label", IntegerType()),
    StructField("slot", IntegerType()), StructField("day", IntegerType()), StructField("ndvi", IntegerType()),
    StructField("scl", IntegerType()), *_bands()])
