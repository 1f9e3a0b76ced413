"""Mergeable statistics of the bands.

A partition (bbox, year) keeps, for each band, the count n, the mean and the sum of squared
deviations of its non-zero values.  Groups of partitions merge without their rows:

    n = sum n_i,  mean = sum n_i mean_i / n,  squared = sum squared_i + sum n_i (mean_i - mean)^2

so a delivery recomputes only the partitions that it changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.sources.tables import read_dataset

PARTITION = ["bbox", "year"]
MOMENTS = "band_index int, band string, n long, mean double, squared double, bbox string, year int"


def band_moments(long_slots: DataFrame, by=tuple(PARTITION), bands=tuple(K.BANDS)) -> DataFrame:
    """n, mean and squared deviation of each band over non-zero values, a row for each partition and band.

    One aggregation, combined in tasks before it is shuffled.  A band without any such value has
    n = 0, no mean and no deviation.
    """
    values = F.array(*[F.struct(F.lit(i).alias("band_index"), F.lit(b).alias("band"), F.col(b).cast("double").alias("v"))
                       for i, b in enumerate(bands)])
    v = F.when(F.col("v") != 0, F.col("v"))
    return long_slots.select(*by, F.inline(values)).groupBy(*by, "band_index", "band") \
        .agg(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("squared"))


def merge_moments(moments: DataFrame, by=()) -> DataFrame:
    """The moments of all rows, or of each ``by``, from those of their partitions."""
    keys = [*by, "band_index", "band"]
    whole = Window.partitionBy(*keys)  # a row for each partition, not for each value
    n, mean = F.sum("n").over(whole), F.sum(F.col("n") * F.col("mean")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    apart = moments.withColumn("_mean", mean).withColumn("_n", n)
    step = F.col("mean") - F.col("_mean")
    return apart.groupBy(*keys).agg(F.max("_n").alias("n"), F.max("_mean").alias("mean"),
                                    (F.sum("squared") + F.sum(F.col("n") * step * step)).alias("squared"))


def normaliser(moments: DataFrame) -> DataFrame:
    """A08 + A09: mean and population standard deviation of each row of moments."""
    return moments.withColumn("std", F.sqrt(F.try_divide("squared", "n"))).drop("n", "squared")


def refresh_moments(long_slots: DataFrame, path: str) -> None:
    """Write the moments of the partitions that ``long_slots`` holds, whole partitions each; others stay as they are."""
    band_moments(long_slots).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*PARTITION).parquet(path)


def read_moments(spark, path: str) -> DataFrame:
    return read_dataset(spark, path, schema=MOMENTS, missing_ok=True)
