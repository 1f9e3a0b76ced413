"""ML queries.  SQL gives their keys, labels and row counts; tests check what the models learn."""

from __future__ import annotations

from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.draws import draw_sql
from cropcube.operators import loader as L
from cropcube.operators import models as M
from cropcube.operators import positions as P
from cropcube.operators import sampling as SM
from cropcube.operators.loader import features
from cropcube.plans import catalog as C
from cropcube.plans import sql as Q
from cropcube.plans.registry import query
from cropcube.session import materialize, shared_path
from cropcube.sources import listing as LI
from cropcube.sources.tables import write_and_verify, write_dataset

_SERIES = Q.SERIES_KEY.split(", ")


def _frames(spark, sf):
    """Train, validation and test frames, normalised by what was fitted on the train year."""
    splits = L.split_by_year(C.series(spark, sf), K.FIXTURE_SPLIT_YEARS)
    # written once to the shared folder: statistics and features read the examples, and the fit reads those many times
    examples = materialize(L.training_examples(splits["train"]), "train-examples")
    means, stds = M.fitted_stats(L.fit_normaliser(L.slots_long(examples)))
    train = materialize(M.to_ml_frame(examples, means=means, stds=stds), "train-features")
    validation = M.to_ml_frame(L.training_examples(splits["validation"]), means=means, stds=stds)
    test = M.to_ml_frame(L.sweep_examples(splits["test"]), means=means, stds=stds)
    return train, validation, test


def _scored(model, split, frame):
    """Scored rows; the prediction is checked by tests, as no SQL fits a model."""
    return M.score(model, frame).where(F.col("prediction").between(0, K.NUM_CLASSES - 1)).select(
        F.lit(split).alias("split"), "bbox", "year", "pixel_id", "CDL", "start_day", "true_label")


_TEST_SQL = f"""SELECT DISTINCT 'test' AS split, bbox, year, pixel_id, CDL, start_day, label AS true_label
FROM sweep_long WHERE year = {K.FIXTURE_SPLIT_YEARS['test']}"""
_VALIDATION_SQL = f"""SELECT DISTINCT 'validation' AS split, bbox, year, pixel_id, CDL, start_day, label AS true_label
FROM train_long WHERE year = {K.FIXTURE_SPLIT_YEARS['validation']}"""
_BOTH = Q.with_(Q.TRAIN, Q.SWEEP.removeprefix(Q.SROWS).lstrip(",\n"))


@query("m01_linear_softmax", "M01 M03", sql=Q.with_(Q.SWEEP) + _TEST_SQL)
def m01_linear_softmax(spark, sf):
    """Fit the linear softmax baseline on the train year, score the test sweep."""
    train, _, test = _frames(spark, sf)
    return _scored(M.fit_linear(train, max_iter=30), "test", test)


@query("m02_mlp_classifier", "M02 M03", sql=_BOTH + _TEST_SQL + " UNION ALL " + _VALIDATION_SQL)
def m02_mlp_classifier(spark, sf):
    """Fit the feed-forward classifier (300 -> 50 -> 7), score the validation year and the test sweep."""
    train, validation, test = _frames(spark, sf)
    model = M.fit_mlp(train, hidden=50, max_iter=30)
    return _scored(model, "validation", validation).unionByName(_scored(model, "test", test))


_ROUNDS, _ITERATIONS = 4, 8


def _rounds(spark, sf):
    """Rounds of the feed-forward classifier on the train year, and the frames of the other two."""
    splits = L.split_by_year(C.series(spark, sf), K.FIXTURE_SPLIT_YEARS)
    series = {n: materialize(splits[n], f"{n}-series") for n in ("train", "validation")}
    means, stds = M.fitted_stats(L.fit_normaliser(L.slots_long(L.training_examples(series["train"]))))
    validation = materialize(M.to_ml_frame(L.training_examples(series["validation"]), means=means, stds=stds), "validation-features")
    test = M.to_ml_frame(L.sweep_examples(splits["test"]), means=means, stds=stds)
    found = M.train_rounds(lambda r: M.to_ml_frame(L.training_examples(series["train"], epoch=r), means=means, stds=stds),
                           validation, rounds=_ROUNDS, iterations=_ITERATIONS)
    return found, validation, test


@query("m02_training_rounds", "M02 L08")
def m02_training_rounds(spark, sf):
    """Training in rounds that go on from the last weights with windows drawn anew; loss and accuracy of both years after each."""
    return spark.createDataFrame(_rounds(spark, sf)[0].metrics, M.METRICS)


@query("m02_predictions", "M02 M03")
def m02_predictions(spark, sf):
    """Predictions of the round of least validation loss for the validation year and the test sweep, beside the true labels."""
    found, validation, test = _rounds(spark, sf)
    columns = [*_SERIES, "start_day", "true_label", "prediction"]
    return M.score(found.best, validation).select(F.lit("validation").alias("split"), *columns).unionByName(
        M.score(found.best, test).select(F.lit("test").alias("split"), *columns))


@query("m01_predictions", "M01 M03 A11")
def m01_predictions(spark, sf):
    """Predictions of the fitted linear softmax for the test sweep, beside the true labels."""
    train, _, test = _frames(spark, sf)
    return M.score(M.fit_linear(train, max_iter=30), test).select(*_SERIES, "start_day", "true_label", "prediction")


@query("m04_model_roundtrip", "M04", sql=Q.with_(Q.SWEEP) + f"""
SELECT DISTINCT bbox, year, pixel_id, CDL, start_day, true AS same_as_fitted
FROM sweep_long WHERE year = {K.FIXTURE_SPLIT_YEARS['test']}""")
def m04_model_roundtrip(spark, sf):
    """Save a fitted model to the shared folder, load it, and compare both models' predictions."""
    train, _, test = _frames(spark, sf)
    model = M.fit_linear(train, max_iter=10)
    loaded = M.load(M.save(model, shared_path(spark, "model-linear")), "linear")
    key = ["bbox", "year", "pixel_id", "CDL", "start_day"]
    ours = M.score(model, test).select(*key, F.col("prediction").alias("fitted"))
    theirs = M.score(loaded, test).select(*key, F.col("prediction").alias("loaded"))
    return ours.join(theirs, key).select(*key, F.col("fitted").eqNullSafe(F.col("loaded")).alias("same_as_fitted"))


@query("s04_results_roundtrip", "S03 S04 S10 S11 S16 T35 A19 U04", sql=Q.with_(C.PRED_SQL) + """
SELECT bbox, year, count(*) AS n_rows, true AS sized FROM results GROUP BY bbox, year""")
def s04_results_roundtrip(spark, sf):
    """Write the predictions partitioned by (bbox, year), verify, and re-read; partitions, files and
    bytes come from the listing, rows from the data."""
    path = shared_path(spark, "results")
    write_and_verify(C.predictions(spark, sf), path)
    files = LI.list_files(spark, path)
    parts = LI.partitions(files, "bbox string, year int")
    sized = (F.col("num_files") > 0) & (F.col("total_bytes") > F.col("num_files"))
    rows = spark.read.parquet(path).groupBy("bbox", "year").agg(F.count("*").alias("n_rows"))
    return parts.join(rows, ["bbox", "year"]).select("bbox", "year", "n_rows", sized.alias("sized"))


_DONE_YEAR = 1995


@query("u01_pending_partitions", "U01 S10 S11 T35", sql=Q.with_(Q.OBS) + f"""
SELECT DISTINCT bbox, year, true AS all_listed FROM obs WHERE year > {_DONE_YEAR}""")
def u01_pending_partitions(spark, sf):
    """Partitions of the observations without series yet, from two listings: no data file is opened.

    Series exist up to a year.  ``all_listed``: the files of all partitions add up to the whole listing.
    """
    source, done = shared_path(spark, "observed"), shared_path(spark, "series")
    obs = C.observations(spark, sf).select("bbox", "year", "pixel_id", "scene_date")
    write_dataset(obs, source)
    write_dataset(obs.where(F.col("year") <= _DONE_YEAR).groupBy("bbox", "year", "pixel_id").count(), done)
    inputs, outputs, keys = LI.list_files(spark, source), LI.list_files(spark, done), "bbox string, year int"
    whole = LI.size(inputs)
    added = LI.partitions(inputs, keys).agg(F.sum("num_files").alias("n"), F.sum("total_bytes").alias("b"))
    same = whole.join(added, (whole["num_files"] == added["n"]) & (whole["total_bytes"] == added["b"])).select(F.lit(True).alias("all_listed"))
    return LI.pending(inputs, outputs, keys).join(same)


@query("s15_training_batches", "S15 D13", sql=Q.with_(Q.TRAIN) + f"""
SELECT count(*) AS n_rows, true AS within_limit
FROM (SELECT DISTINCT {Q.SERIES_KEY}, start_day FROM train_long)""")
def s15_training_batches(spark, sf):
    """Feature rows handed to a consumer in batches of 1028: all rows, no batch above."""
    ex = C.train_examples(spark, sf).select("pixel_id", features(F.col("slots")).alias("features"))
    size = SM.batches(ex, K.BATCH_SIZE).groupBy("partition", "batch").agg(F.count("features").alias("n"))
    return size.agg(F.sum("n").alias("n_rows"), (F.max("n") <= K.BATCH_SIZE).alias("within_limit"))


_EXAMPLE = [*_SERIES, "start_day"]


def _position_sql(rows: str, key: list[str]) -> str:
    return f""",
examples AS (SELECT DISTINCT {', '.join(_EXAMPLE)}, label FROM {rows}),
placed AS (
  SELECT *, row_number() OVER (ORDER BY {draw_sql("'shuffle'", *key, seed=7)}, {', '.join(key)}) - 1 AS position FROM examples)
"""


@query("l10_shuffled_examples", "L10", sql=Q.with_(Q.TRAIN) + _position_sql("train_long", _SERIES) + "SELECT * FROM placed")
def l10_shuffled_examples(spark, sf):
    """Training examples in a seeded global random order, with their positions."""
    examples = materialize(C.train_examples(spark, sf).select(*_EXAMPLE, "label"), "examples")
    return P.shuffled(examples, key=_SERIES, seed=7).orderBy("position")


@query("s15_exact_batches", "S15 L10", sql=Q.with_(Q.SWEEP) + _position_sql("sweep_long", _EXAMPLE) + f"""
SELECT position // {K.BATCH_SIZE} AS batch, count(*) AS n_rows, sum(label)::BIGINT AS label_sum,
       min(position) AS first_position, max(position) AS last_position, string_agg(pixel_id, ',' ORDER BY position) AS pixels
FROM placed GROUP BY position // {K.BATCH_SIZE}""")
def s15_exact_batches(spark, sf):
    """Shuffled examples of the sweep, stored in order and handed on in batches: 1028 rows each but for the last, in the shuffled order."""
    path = shared_path(spark, "shuffled")
    examples = materialize(C.sweep(spark, sf).select(*_EXAMPLE, "label"), "examples")
    P.shuffled(examples, key=_EXAMPLE, seed=7).orderBy("position").write.parquet(path)
    steps = P.Batches(spark, path).stacked("position", "label", "pixel_id")
    total = F.aggregate("label", F.lit(0).cast("long"), lambda n, x: n + x)
    return steps.select("batch", F.size("label").cast("long").alias("n_rows"), total.alias("label_sum"),
                        F.array_min("position").alias("first_position"), F.array_max("position").alias("last_position"),
                        F.concat_ws(",", F.col("pixel_id").cast("array<string>")).alias("pixels"))


@query("s14_interleaved_files", "S14", sql=Q.with_(Q.OBS) + f""",
files AS (SELECT year, pixel_id, scene_date, tile, row_number() OVER (PARTITION BY year ORDER BY pixel_id, scene_date, tile) AS place FROM obs)
SELECT year, pixel_id, scene_date, tile, row_number() OVER (ORDER BY place, year) - 1 AS position FROM files""")
def s14_interleaved_files(spark, sf):
    """Observations stored in a file for each year, read in turn from all of them."""
    path = shared_path(spark, "years")
    obs = C.observations(spark, sf).select("year", "pixel_id", "scene_date", "tile")
    obs.repartition("year").sortWithinPartitions("year", "pixel_id", "scene_date", "tile").write.partitionBy("year").parquet(path)
    return P.interleaved(spark.read.parquet(path))
