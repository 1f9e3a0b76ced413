"""Models learn a planted signal; statistics count every value; sessions need no folder to read."""

import subprocess
import sys

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cropcube.operators import models as M
from cropcube.operators import sampling as SM
from cropcube.operators import scenes as SC
from cropcube.operators import stats as ST


def test_models_beat_the_majority(spark):
    """Label 3 where the first feature is high, else 1: both models find it."""
    n = M.N_FEATURES
    x = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (F.xxhash64("id", i) % 1000) / 1000.0)
    rows = spark.range(600).select("id", x.alias("x"))
    rows = rows.select(F.when(F.get("x", F.lit(0)) > 0, 3.0).otherwise(1.0).alias("label"),
                       array_to_vector(F.transform("x", lambda v, i: F.when(i == 0, v * 5).otherwise(v * 0.1))).alias("features"))
    train, held = rows.limit(400).cache(), rows.subtract(rows.limit(400))
    share = held.where("label = 3").count() / held.count()
    for model in (M.fit_linear(train, 30), M.fit_mlp(train, 10, 60)):
        got = M.accuracy_of(model, held).first()
        assert got.n == held.count() and got.accuracy > max(share, 1 - share) + 0.2


def test_histogram_counts_every_value(spark):
    df = spark.createDataFrame([(v,) for v in (-5, 0, 9_999, 10_000, 16_000, 65_535)], "b INT")
    r = ST.band_distribution(df, ["b"]).first()
    assert r.n == 6 == r.h_under + r.h_over + sum(r[f"h{i}"] for i in range(10)) and (r.h_under, r.h_over) == (1, 2)


def test_seed_changes_the_tile(spark):
    tiles = spark.createDataFrame([(t,) for t in ("15SYU", "15SXU", "15SYT", "15SYV")], "mgrs STRING")
    assert len({SC.pick_tile(tiles, seed=s).first().mgrs for s in range(12)}) > 1


def test_hash_sample_share(spark):
    df = spark.range(-20_000, 20_000)
    a, b = (SM.hash_sample(df, ("id",), 0.1, seed=s) for s in (0, 1))
    assert 3_600 < a.count() < 4_400 and a.intersect(b).count() < 700
    assert 0.4 < a.where("id < 0").count() / a.count() < 0.6


def test_batches_hold_the_limit(spark):
    got = SM.batches(spark.range(0, 5000, 1, 3), 100).groupBy("partition", "batch").count()
    assert got.agg(F.sum("count")).first()[0] == 5000 and got.agg(F.max("count")).first()[0] == 100


def test_write_and_verify_counts(spark, tmp_path):
    from cropcube.sources.tables import write_and_verify
    df = spark.range(100).select(F.lit("b").alias("bbox"), (F.col("id") % 3).cast("int").alias("year"), "id")
    assert write_and_verify(df, str(tmp_path / "a")) == 100
    assert write_and_verify(df.where("year = 1").limit(7), str(tmp_path / "b")) == 7
    write_and_verify(df.where("year = 0"), str(tmp_path / "c"))
    with pytest.raises(ValueError):  # a part that another write left makes the counts differ
        write_and_verify(df.where("year = 1"), str(tmp_path / "c"))


def test_without_a_named_folder(tmp_path):
    """A local session that names no checkpoint folder runs all queries, and its setting stays unset."""
    import os
    code = ("import sys; sys.path.insert(0, '.'); from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as E\n"
            "print('ROWS', E.entry(s).count(), E.queries()['s09_parse_catalog'](s, E.SMOKE_SF).count(), "
            "s.conf.get('spark.checkpoint.dir', None))\n")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600,
                         env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, cwd=os.path.dirname(os.path.dirname(__file__)))
    assert "ROWS" in out.stdout and out.stdout.strip().endswith("None"), out.stderr[-1500:]


def test_a_cluster_must_name_the_folder():
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    from cropcube.session import checkpoint_dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)


def _planted(spark, epoch, rows=400):
    """Label 3 where the first feature is high, else 1; the rest is noise that each epoch draws anew."""
    noise = F.transform(F.sequence(F.lit(0), F.lit(M.N_FEATURES - 1)), lambda i: (F.xxhash64("id", i, F.lit(epoch)) % 1000) / 10_000.0)
    high = (F.xxhash64("id") % 2) == 0
    x = F.transform(noise, lambda v, i: F.when(i == 0, F.when(high, 3.0).otherwise(-3.0)).otherwise(v))
    return spark.range(rows).select(F.when(high, 3.0).otherwise(1.0).alias("label"), array_to_vector(x).alias("features"))


def test_rounds_go_on_from_the_last_weights(spark):
    validation = _planted(spark, 99, 300).cache()
    found = M.train_rounds(lambda r: _planted(spark, r), validation, rounds=4, iterations=4, hidden=8)
    rounds, losses = [m[0] for m in found.metrics], [m[5] for m in found.metrics]
    assert rounds == [0, 1, 2, 3] and losses[-1] < losses[0] and {m[1] for m in found.metrics} == {400} and {m[4] for m in found.metrics} == {300}
    alone = M.train_rounds(lambda r: _planted(spark, 3), validation, rounds=1, iterations=4, hidden=8)
    assert losses[-1] < alone.metrics[0][5]  # four warm rounds are more than one from the start
    share = validation.where("label = 3").count() / 300
    assert found.metrics[-1][6] > max(share, 1 - share) + 0.2
    scored = M.score(found.best, validation)
    assert scored.where("prediction = true_label").count() / 300 == pytest.approx(min(found.metrics, key=lambda m: m[5])[6])


def test_rounds_stop_without_progress(spark):
    noise = F.transform(F.sequence(F.lit(0), F.lit(M.N_FEATURES - 1)), lambda i: (F.xxhash64("id", i) % 1000) / 500.0)
    train = spark.range(60).select((F.xxhash64("id", F.lit(5)) % 2 + 2).cast("double").alias("label"), array_to_vector(noise).alias("features"))
    held = spark.range(1000, 1060).select((F.xxhash64("id", F.lit(5)) % 2 + 2).cast("double").alias("label"), array_to_vector(noise).alias("features"))
    found = M.train_rounds(lambda r: train, held.cache(), rounds=12, iterations=15, hidden=20, patience=2)
    losses = [m[5] for m in found.metrics]
    assert len(losses) < 12 and min(range(len(losses)), key=losses.__getitem__) == len(losses) - 3  # learnt by heart, then stopped


def test_no_validation_rows(spark):
    found = M.train_rounds(lambda r: _planted(spark, r, 50), _planted(spark, 0, 0), rounds=1, iterations=2, hidden=4)
    assert found.metrics[0][4:] == (0, None, None)


def test_filtered_predictions_are_made_once(spark):
    """A filter on the prediction works on what the model returned; it does not run the model for its own conditions."""
    frame = _planted(spark, 0, 60).withColumn("id", F.monotonically_increasing_id())
    model = M.fit_mlp(frame, hidden=4, max_iter=3)
    scored = M.score(model, frame)
    kept = scored.where(F.col("prediction").between(0, 6)).select("id", "true_label")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert any("prediction" in line for line in filters) and not any("UDF" in line for line in filters)
    plain = model.transform(frame).selectExpr("id", "CAST(prediction AS INT) AS prediction", "CAST(label AS INT) AS true_label")
    assert sorted(scored.select(plain.columns).collect()) == sorted(plain.collect()) and kept.count() == 60
