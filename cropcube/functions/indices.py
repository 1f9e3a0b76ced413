"""Vegetation indices as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropcube import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ndvi(red, nir) -> Column:
    """(nir - red) / (nir + red) as DOUBLE; null when nir + red = 0."""
    red, nir = _c(red).cast("double"), _c(nir).cast("double")
    return F.try_divide(nir - red, nir + red)


def ndvi_percent(red, nir) -> Column:
    """NDVI x 100 truncated toward zero to INT, clipped to [-100, 100].

    0/0 (both bands zero) gives 0: the value is undefined in the original
    and is not a model feature.
    """
    v = F.coalesce((ndvi(red, nir) * F.lit(100.0)).cast("int"), F.lit(0))
    return F.greatest(F.lit(-100), F.least(F.lit(100), v))


def series_ndvi(bands_rows, drop_zero_sum: bool = False) -> Column:
    """NDVI per image of array<array<int>> band rows (12 per image).

    Default keeps a null in place for a zero-sum image so the result still
    lines up with the image dates; ``drop_zero_sum=True`` removes those
    images instead (the original debug behaviour).
    """
    vals = F.transform(_c(bands_rows), lambda b: ndvi(b[K.RED_INDEX], b[K.NIR_INDEX]))
    if drop_zero_sum:
        return F.filter(vals, lambda v: v.isNotNull())
    return vals
