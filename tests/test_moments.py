"""Statistics of partitions merge to those of all rows."""

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.operators import loader as L
from cropcube.operators import moments as MO


def _slots(spark, rows):
    return spark.createDataFrame([(b, y, *v) for b, y, v in rows], "bbox string, year int, " + ", ".join(f"{b} int" for b in K.BANDS))


def _random(seed, n=300):
    rng = random.Random(seed)
    return [(rng.choice("abc"), rng.choice([1, 2]), [0 if i == 11 else rng.choice([0, rng.randrange(10_000)]) for i in range(12)]) for _ in range(n)]


def test_merged_equal_one_pass(spark):
    rows = _random(1) + [("lone", 1, [5] + [0] * 11)]
    df = _slots(spark, rows)
    merged = MO.normaliser(MO.merge_moments(MO.band_moments(df))).collect()
    whole = {r.band: r for r in L.fit_normaliser(df).collect()}
    for r in merged:
        assert r["mean"] == pytest.approx(whole[r.band]["mean"]) and r["std"] == pytest.approx(whole[r.band]["std"])
    by_year = {(r.year, r.band): r for r in MO.merge_moments(MO.band_moments(df), by=("year",)).collect()}
    for i, band in enumerate(K.BANDS):
        for year in (1, 2):
            v = [x[2][i] for x in rows if x[1] == year and x[2][i]]
            r = by_year[year, band]
            assert r.n == len(v) and (r["mean"] is None) == (not v)
            if v:
                assert (r["mean"], r.squared / r.n) == (pytest.approx(statistics.fmean(v)), pytest.approx(statistics.pvariance(v)))


def test_merge_is_stable_for_values_far_from_zero(spark):
    rows = [("a", 1, [10 ** 9 + i % 3] * 12) for i in range(30)] + [("b", 1, [10 ** 9 + 1 + i % 3] * 12) for i in range(30)]
    r = MO.normaliser(MO.merge_moments(MO.band_moments(_slots(spark, rows)))).first()
    assert r["std"] == pytest.approx(statistics.pstdev([x[2][0] for x in rows]), rel=1e-6)


def test_refresh_touches_changed_partitions_only(spark, tmp_path):
    path = str(tmp_path / "moments")
    first, second = _random(2), [r for r in _random(3) if r[0] == "b" and r[1] == 2]
    MO.refresh_moments(_slots(spark, first), path)
    files = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    MO.refresh_moments(_slots(spark, second), path)
    after = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    assert {f for f in files if "bbox=b/year=2" not in f} == {f for f in after if "bbox=b/year=2" not in f and after[f] == files.get(f)}
    now = [r for r in first if r[:2] != ("b", 2)] + second
    got = {r.band: r for r in MO.normaliser(MO.merge_moments(MO.read_moments(spark, path))).collect()}
    for r in L.fit_normaliser(_slots(spark, now)).collect():
        assert (got[r.band]["mean"], got[r.band]["std"]) == (pytest.approx(r["mean"]), pytest.approx(r["std"]))


def test_no_statistics_yet(spark, tmp_path):
    assert MO.merge_moments(MO.read_moments(spark, str(tmp_path / "none"))).collect() == []
    assert MO.normaliser(MO.band_moments(_slots(spark, []))).select(F.count("*")).first()[0] == 0
