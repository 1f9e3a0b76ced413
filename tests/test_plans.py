"""Plan shape: no Python in core queries, pruned and pushed scans, broadcasts where bounded."""

import pytest

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["l09_train_slots", "j07_sweep_slots", "t15_encoded_series",
                                  "t23_decoded_series", "m05_predictions", "a01_class_share", "j04_scene_chain",
                                  "j05_footprint_search", "l10_shuffled_examples", "s14_interleaved_files", "s15_exact_batches",
                                  "a16_sketch_quantiles", "u01_pending_partitions", "r01_compacted_ingest"])
def test_no_python_udf(spark, sf_small, name):
    plan = _plan(E.queries()[name](spark, sf_small))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_is_pruned(spark, sf_small):
    plan = _plan(E.queries()["l09_train_slots"](spark, sf_small))
    assert "l_extendedprice" not in plan and "l_comment" not in plan


def test_partition_filter_reaches_scan(spark, tmp_path, sf_small):
    from pyspark.sql import functions as F
    from cropcube.sources.tables import read_dataset, write_dataset
    obs = E.queries()["f06_observations"](spark, sf_small)
    path = str(tmp_path / "obs")
    write_dataset(obs, path)
    df = read_dataset(spark, path, where=(F.col("year") == 1998) & (F.col("scl") == 4), columns=["pixel_id", "scl"])
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters" in plan
    assert df.count() == obs.where("year = 1998 AND scl = 4").count()


def test_class_dictionary_is_broadcast(spark, sf_small):
    plan = _plan(E.queries()["a01_class_share"](spark, sf_small))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_missing_dataset_reads_empty(spark, tmp_path):
    from cropcube.sources.tables import read_dataset
    df = read_dataset(spark, str(tmp_path / "not_written_yet"), schema="bbox STRING, year INT", missing_ok=True)
    assert df.count() == 0 and df.columns == ["bbox", "year"]
