"""Bucketed range joins emit each pair once and agree with brute force."""

from pyspark.sql import functions as F

from cropcube.operators import observe as OB
from cropcube.operators import scenes as SC
from cropcube.sources import fixtures as FX


def test_search_pairs_once_and_match_brute_force(spark, sf_small):
    scenes = FX.scenes(spark, sf_small)
    aois = SC.aoi_frame(spark, years=FX.RASTER_YEARS)
    hits = SC.search(scenes, aois).select("bbox", "year", "scene_id")
    assert hits.count() == hits.distinct().count()
    # brute force: every pair tested (fine on the small fixture)
    s = scenes.withColumn("_d", F.to_date(F.substring("datetime", 1, 10)))
    brute = s.crossJoin(aois).where(
        (F.col("min_lon") <= F.col("a_max_lon")) & (F.col("a_min_lon") <= F.col("max_lon"))
        & (F.col("min_lat") <= F.col("a_max_lat")) & (F.col("a_min_lat") <= F.col("max_lat"))
        & (F.year("_d") == F.col("year"))).select("bbox", "year", "scene_id")
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, brute.collect()))


def test_sample_cells_one_row_per_covering_tile(spark):
    samples = spark.createDataFrame([(1, 2000, -90.5, 34.5), (2, 2000, -91.95, 35.05), (3, 2000, -80.0, 30.0)],
                                    "pixel_id LONG, year INT, lon DOUBLE, lat DOUBLE")
    tiles = spark.createDataFrame([(2000, "AF", -91.0, 34.0, -89.8, 35.2), (2000, "NF", -92.0, 34.0, -90.8, 35.2),
                                   (2000, "RO", -92.0, 35.0, -90.8, 36.2)],
                                  "year INT, mgrs STRING, min_lon DOUBLE, min_lat DOUBLE, max_lon DOUBLE, max_lat DOUBLE")
    out = OB.sample_cells(samples, tiles, FX.scene_cell)
    pairs = sorted((r.pixel_id, r.mgrs) for r in out.collect())
    assert pairs == [(1, "AF"), (2, "NF"), (2, "RO")]
