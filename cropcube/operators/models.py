"""Spark ML models over the 25 x 12 slot features.

The original trains a neural network on one machine.  Here training is a
distributed Spark ML fit over the feature DataFrame: the linear softmax
baseline is multinomial logistic regression, the classifier a multilayer
perceptron (the convolution network itself is not rebuilt).  Scoring is a
plain ``transform``, so the 15-day sweep is scored in one job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel,
                                       MultilayerPerceptronClassificationModel,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.hof import record
from cropcube.operators.evaluate import accuracy
from cropcube.operators.loader import features
from cropcube.session import materialize

N_FEATURES = K.MAX_IMAGES_PER_SERIES * len(K.BANDS)  # 300


def to_ml_frame(examples: DataFrame, keep=("bbox", "year", "pixel_id", "CDL", "start_day"),
                means=None, stds=None) -> DataFrame:
    """Examples -> (keys, features vector of 300, label double); ``means`` and ``stds`` as fitted."""
    return examples.select(*keep, array_to_vector(features(F.col("slots"), means, stds)).alias("features"),
                           F.col("label").cast("double").alias("label"))


def fit_linear(train: DataFrame, max_iter: int = 50, reg: float = 0.0) -> LogisticRegressionModel:
    """Linear softmax baseline (multinomial logistic regression)."""
    lr = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg,
                            featuresCol="features", labelCol="label")
    return lr.fit(train)


def fit_mlp(train: DataFrame, hidden: int = 50, max_iter: int = 50, seed: int = 7) -> MultilayerPerceptronClassificationModel:
    """M02 (re-aimed): feed-forward classifier 300 -> hidden -> 7."""
    mlp = MultilayerPerceptronClassifier(layers=[N_FEATURES, hidden, K.NUM_CLASSES], maxIter=max_iter,
                                         seed=seed, featuresCol="features", labelCol="label")
    return mlp.fit(train)


def fitted_stats(normaliser: DataFrame) -> tuple[list[float], list[float]]:
    """Means and standard deviations of ``fit_normaliser``: one row a band, so 12 at most.

    A band without any value, or with one value alone, keeps its scale.
    """
    rows = sorted(normaliser.collect(), key=lambda r: r.band_index)
    return [r["mean"] or 0.0 for r in rows], [r["std"] or 1.0 for r in rows]


def accuracy_of(model: Model, frame: DataFrame) -> DataFrame:
    """Rows and accuracy of a model on a frame, such as the validation year."""
    return accuracy(score(model, frame))


def score(model: Model, frame: DataFrame) -> DataFrame:
    """Predictions as int labels next to the keys.

    A generator of one row makes them: a filter on the prediction stays above it, as pushed below
    it would build the features and run the model again for each of its conditions.
    """
    out = model.transform(frame)
    scored = record(prediction=F.col("prediction").cast("int"), true_label=F.col("label").cast("int"))
    return out.select(*[c for c in out.columns if c != "prediction"], F.inline_outer(F.array(scored)))


METRICS = ("round int, train_rows long, train_loss double, train_accuracy double, "
           "validation_rows long, validation_loss double, validation_accuracy double")


@dataclass
class Rounds:
    """What :func:`train_rounds` returns: the last model, the one of least validation loss, a metric row a round."""

    last: Model
    best: Model
    metrics: list[tuple]


def loss_of(model: Model, frame: DataFrame) -> tuple[int, float | None, float | None]:
    """Rows, mean cross-entropy and accuracy of a model on a frame, in one aggregation."""
    p = F.get(vector_to_array("probability"), F.col("label").cast("int"))
    hit = (F.col("prediction") == F.col("label")).cast("double")
    r = model.transform(frame).agg(F.count("*").alias("n"), F.avg(-F.log(F.greatest(p, F.lit(1e-7)))).alias("loss"),
                                   F.avg(hit).alias("accuracy")).first()
    return r.n, r.loss, r.accuracy


def train_rounds(train_of: Callable[[int], DataFrame], validation: DataFrame, rounds: int = K.MAX_EPOCHS, iterations: int = 5,
                 hidden: int = 50, seed: int = 7, patience: int | None = None) -> Rounds:
    """The feed-forward classifier in rounds, each from the weights of the one before, validated after each.

    ``train_of(epoch)`` gives the frame of a round: windows and images are drawn anew each
    time.  It is written to the shared folder, since a fit reads it many times.  ``patience``:
    training ends when the validation loss has not fallen for so many rounds (None: never).
    """
    model = best = None
    least, best_round, metrics = float("inf"), 0, []
    for r in range(rounds):
        frame = materialize(train_of(r), f"round-{r}")
        mlp = MultilayerPerceptronClassifier(layers=[N_FEATURES, hidden, K.NUM_CLASSES], maxIter=iterations, seed=seed,
                                             featuresCol="features", labelCol="label")
        if model is not None:
            mlp.setInitialWeights(model.weights)
        model = mlp.fit(frame)
        metrics.append((r, *loss_of(model, frame), *loss_of(model, validation)))
        loss = metrics[-1][5]
        if best is None or (loss is not None and loss < least):
            least, best, best_round = least if loss is None else loss, model, r
        if patience is not None and r - best_round >= patience:
            break
    return Rounds(model, best, metrics)


def save(model: Model, path: str) -> str:
    """Persist a fitted model (overwrites)."""
    model.write().overwrite().save(path)
    return path


def load(path: str, kind: str = "linear") -> Model:
    """Load a model saved by ``save``."""
    cls = {"linear": LogisticRegressionModel, "mlp": MultilayerPerceptronClassificationModel}[kind]
    return cls.load(path)
