"""Scoring and evaluation.

``linear_scores`` is an integer linear scorer over the slot bands: an
exact, engine-independent stand-in for a trained network, used so the
sweep -> predictions -> reports chain has an exact SQL oracle.  Trained
Spark ML models plug into the same chain through ``models.score``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.labels import argmax


def scorer_weight(c: int, b: int) -> int:
    """Weight of band ``b`` for class ``c`` in the integer scorer."""
    return (c * 13 + b * 7) % 11 - 5


def linear_scores(examples: DataFrame, n_classes: int = K.NUM_CLASSES) -> DataFrame:
    """M03 (exact form): score_c = sum over slots, bands of band_b * w(c, b); T33 argmax.

    The score is linear, so the slot bands are summed once per band (one
    ``zip_with`` per slot) and the class scores are 7 dot products of 12
    plain columns, which stay in generated code.
    """
    nb = len(K.BANDS)
    totals = F.aggregate("slots", F.array_repeat(F.lit(0).cast("bigint"), nb),
                         lambda acc, s: F.zip_with(acc, s["bands"], lambda a, v: a + v.cast("bigint")))
    df = examples.withColumn("_band_sums", totals)
    sums = [F.col("_band_sums")[i] for i in range(nb)]
    scores = F.array(*[sum((sums[i] * F.lit(scorer_weight(c, i)) for i in range(nb)), F.lit(0).cast("bigint"))
                       for c in range(n_classes)])
    return df.withColumn("scores", scores).drop("_band_sums").withColumn("prediction", argmax(F.col("scores")))


def prediction_date(year, start_day, days: int = K.DAYS_IN_SERIES):
    """Nominal date = day (start_day + 120) of the year, 1-based day of year."""
    y = F.col(year) if isinstance(year, str) else year
    s = F.col(start_day) if isinstance(start_day, str) else start_day
    return F.date_add(F.make_date(y, F.lit(1), F.lit(1)), (s + F.lit(days - 1)).cast("int"))


def accuracy(results: DataFrame, by=(), true: str = "true_label", pred: str = "prediction") -> DataFrame:
    """Share of rows where prediction equals the true label."""
    hit = (F.col(true) == F.col(pred)).cast("int")
    return results.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg(hit), 6).alias("accuracy"))


def confusion_matrix(results: DataFrame, normalize: str = "pred", true: str = "true_label",
                     pred: str = "prediction", n_classes: int = K.NUM_CLASSES) -> DataFrame:
    """Full n x n matrix; each predicted column sums to 1 when normalize='pred'.

    One aggregation by (true, predicted), combined in tasks; its few counts become one
    map, from which the grid is filled.  Absent pairs show 0, an empty predicted column gives
    a null share.
    """
    known = F.col(true).between(0, n_classes - 1) & F.col(pred).between(0, n_classes - 1)
    at = F.when(known, (F.col(true) * F.lit(n_classes) + F.col(pred)).cast("int"))
    counts = results.groupBy(at.alias("at")).agg(F.count("*").alias("n")) \
        .agg(F.map_from_entries(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "n")))).alias("counts"))
    cells = counts.select("counts", F.explode(F.sequence(F.lit(0), F.lit(n_classes * n_classes - 1))).alias("at")).select(
        F.floor(F.col("at") / n_classes).cast("int").alias("true_label"), (F.col("at") % n_classes).alias("predicted"),
        F.coalesce(F.try_element_at("counts", F.col("at")), F.lit(0).cast("long")).alias("count"))
    total = F.sum("count").over(Window.partitionBy(*{"pred": ["predicted"], "true": ["true_label"]}.get(normalize, [])))
    return cells.select("true_label", "predicted", "count",
                        F.round(F.try_divide(F.col("count").cast("double"), total.cast("double")), 6).alias("share"))
