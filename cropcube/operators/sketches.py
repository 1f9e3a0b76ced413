"""Mergeable quantile sketches of the bands.

A partition keeps a KLL sketch of each band: a few kilobytes whatever its rows.  Sketches of
partitions merge to that of any group of them, and give quantiles whose rank is off by a
bounded share, so neither rows nor the distinct values of a group are needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube import constants as K

#: Size parameter of the sketches, and the rank error it keeps to (99 % of the time 0.7 %; about twice that always).
SIZE, RANK_ERROR = 400, 0.015


def band_sketches(long_slots: DataFrame, by=("bbox", "year"), bands=tuple(K.BANDS), size: int = SIZE) -> DataFrame:
    """A sketch of each band's non-zero values, a row for each partition and band that has any."""
    values = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).cast("long").alias("v")) for b in bands])
    return long_slots.select(*by, F.inline(values)).where("v <> 0").groupBy(*by, "band") \
        .agg(F.kll_sketch_agg_bigint("v", size).alias("sketch"))


def merge_sketches(sketches: DataFrame, by=()) -> DataFrame:
    """Sketches of groups of partitions, from theirs alone."""
    return sketches.groupBy(*by, "band").agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, at=(0.25, 0.5, 0.75), by=()) -> DataFrame:
    """n and the value at each rank, a row for each sketch and rank."""
    points = F.array(*[F.struct(F.lit(q).alias("rank"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias("value")) for q in at])
    return sketches.select(*by, "band", F.kll_sketch_get_n_bigint("sketch").alias("n"), F.inline(points))
