"""Class and band statistics.

Every aggregate here is a hash aggregate with a partial (map-side) stage;
window totals run over the already-aggregated rows (a few per class), never
over the raw pixels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropcube import constants as K


def class_share(df: DataFrame, by=("year",), cls: str = "CDL") -> DataFrame:
    """A01 + W01 + T37: count per (by..., class), share of the group total.

    ``count(class)`` counts non-null classes, so the null-class group
    reports 0 and adds nothing to the total (the original's behaviour).
    """
    counts = df.groupBy(*by, cls).agg(F.count(cls).alias("count"))
    w = Window.partitionBy(*by)
    total = F.sum("count").over(w)
    return (counts.withColumn("total_count", total)
            .withColumn("percentage", F.round(F.try_divide(F.col("count") * F.lit(100.0), F.col("total_count")), 2)))


def top_classes(share: DataFrame, k: int = 5, by=("year",), cls: str = "CDL") -> DataFrame:
    """W02 + L03: the ``k`` largest classes per group by percentage.

    Ties are broken by count, then class name (nulls last) so the result is
    deterministic; Spark plans this with a WindowGroupLimit.
    """
    w = Window.partitionBy(*by).orderBy(F.desc("percentage"), F.desc("count"), F.asc_nulls_last(cls))
    return (share.withColumn("row_num", F.row_number().over(w))
            .where(F.col("row_num") <= k)
            .orderBy(*by, F.asc("row_num")))


def count_by_class_year(df: DataFrame, cls: str = "CDL") -> DataFrame:
    """A02 + L02: rows per (class, year), largest first, ties by year and class."""
    return (df.groupBy(cls, "year").agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), "year", F.asc_nulls_last(cls)))


def value_shares(df: DataFrame, keys=("bbox", "year"), cls: str = "CDL", min_percent: float | None = None) -> DataFrame:
    """A03 (+F10): count and percent of all pixels per area, null class included.

    Unlike ``class_share`` the denominator counts every pixel (the original
    counted each value of the flattened grid, the empty class too).
    """
    counts = df.groupBy(*keys, cls).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*keys))
    out = counts.withColumn("percent", F.col("count") * F.lit(100.0) / total)
    if min_percent is not None:
        out = out.where(F.col("percent") >= F.lit(float(min_percent)))
    return out


def aoi_class_table(shares: DataFrame, classes: list[str], keys=("bbox", "year"), cls: str = "CDL") -> DataFrame:
    """One row per area, integer percent per class as columns, plus size.

    ``classes`` fixes the pivot columns (no extra pass to discover them).
    """
    size = shares.groupBy(*keys).agg(F.sum("count").cast("bigint").alias("size"))
    wide = (shares.where(F.col(cls).isNotNull())
            .groupBy(*keys).pivot(cls, classes)
            .agg(F.first(F.col("percent").cast("int"))))
    wide = wide.select(*keys, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in classes])
    return wide.join(size, list(keys))


def label_histogram(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A10: examples per legend label, zero rows kept for absent labels.

    The counts are as few as the labels, so either side of this join is small.
    """
    spark = df.sparkSession
    legend = spark.createDataFrame([(i, n) for i, n in enumerate(K.LABEL_LEGEND)], "label INT, label_name STRING")
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("count"))
    return (legend.join(counts, "label", "left")
            .select("label", "label_name", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def band_distribution(long_df: DataFrame, value_cols: list[str], by: list[str] | None = None,
                      exact: bool = True, bins: int = 10, lo: float = 0.0, hi: float = 10000.0) -> DataFrame:
    """Per band min / max / mean / quartiles / fixed-width histogram.

    Values under ``lo`` and over ``hi`` count in bins of their own, so every value is in one.

    Input is long form (one row per filled slot); output is one row per
    (by..., band).  The exact ``percentile`` keeps a value -> frequency map
    per group, so its memory is bounded by the distinct band values (at most
    65,536 for unsigned 16-bit bands), not by the row count; ``exact=False``
    uses ``percentile_approx`` for unbounded value domains.
    """
    by = by or []
    stacked = long_df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("band"), F.col(c).cast("double").alias("v")) for c in value_cols])).alias("s")
    ).select(*by, "s.band", "s.v")
    q = (lambda p: F.percentile("v", p)) if exact else (lambda p: F.percentile_approx("v", p, 10000).cast("double"))
    width = (hi - lo) / bins
    agg = [F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"),
           F.round(F.avg("v"), 6).alias("mean"),
           F.round(q(0.25), 6).alias("p25"), F.round(q(0.5), 6).alias("p50"), F.round(q(0.75), 6).alias("p75")]
    agg += [F.count(F.when(F.col("v") < lo, 1)).alias("h_under"), F.count(F.when(F.col("v") > hi, 1)).alias("h_over")]
    for b in range(bins):
        a, z = lo + b * width, lo + (b + 1) * width
        cond = (F.col("v") >= a) & ((F.col("v") < z) if b < bins - 1 else (F.col("v") <= z))
        agg.append(F.count(F.when(cond, 1)).alias(f"h{b}"))
    return stacked.groupBy(*by, "band").agg(*agg)


def grid_shape(strips: DataFrame, keys=("raster_id",)) -> DataFrame:
    """Rows and columns of each raster."""
    return strips.groupBy(*keys).agg((F.max("row") + 1).alias("n_rows"),
                                      F.max(F.size("values")).alias("n_cols"))


def extent(df: DataFrame, x: str = "lon", y: str = "lat", by=()) -> DataFrame:
    """min/max of two coordinates (the extent of a sample set)."""
    return df.groupBy(*by).agg(F.min(x).alias(f"min_{x}"), F.max(x).alias(f"max_{x}"),
                               F.min(y).alias(f"min_{y}"), F.max(y).alias(f"max_{y}"))
