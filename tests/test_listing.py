"""Listings tell partitions, files and exact bytes without opening a data file."""

import os

from cropcube.sources import listing as LI

KEYS = "bbox string, year int"


def _dataset(spark, path):
    df = spark.createDataFrame([("1, 2", 1, 1.0), ("a+b %41/é", 2, 2.0), (None, 2, 3.0), ("1, 2", 3, 4.0)], "bbox string, year int, v double")
    df.write.partitionBy("bbox", "year").parquet(path)
    return df


def test_partitions_and_exact_bytes(spark, tmp_path):
    path = str(tmp_path / "some data")
    df = _dataset(spark, path)
    files = LI.list_files(spark, path)
    on_disk = {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    assert {r.path.removeprefix("file:"): r.length for r in files.collect()} == on_disk
    total = LI.size(files).first()
    assert (total.num_files, total.total_bytes) == (len(on_disk), sum(on_disk.values()))
    assert {(r.bbox, r.year) for r in LI.partitions(files, KEYS).collect()} == {(r.bbox, r.year) for r in df.collect()}


def test_no_file_is_opened(spark, tmp_path):
    for i, name in enumerate(("bbox=x/year=1/a.parquet", "bbox=x/year=2/b.parquet", "bbox=x/year=2/_skip.parquet", "bbox=%/year=3/c.parquet")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"no parquet" * (i + 1))  # reading any would fail
    files = LI.list_files(spark, str(tmp_path))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    assert {tuple(r) for r in LI.partitions(files, KEYS).collect()} == {("x", 1, 1, 10), ("x", 2, 1, 20), ("%", 3, 1, 40)}


def test_missing_roots_and_pending(spark, tmp_path):
    path = str(tmp_path / "in")
    _dataset(spark, path)
    nothing = LI.list_files(spark, str(tmp_path / "none"))
    assert tuple(LI.size(nothing).first()) == (0, 0, 0.0) and LI.partitions(nothing, KEYS).collect() == []
    spark.createDataFrame([("1, 2", 1, 0.0)], "bbox string, year int, v double").write.partitionBy("bbox", "year").parquet(str(tmp_path / "out"))
    left = LI.pending(LI.list_files(spark, path), LI.list_files(spark, str(tmp_path / "out"), str(tmp_path / "none")), KEYS)
    assert {tuple(r) for r in left.collect()} == {("a+b %41/é", 2), (None, 2), ("1, 2", 3)}
