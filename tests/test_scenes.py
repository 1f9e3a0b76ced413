"""Scenes: nulls in usable areas and asset links; splits read their own partitions only."""

import json

from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.operators import loader as L
from cropcube.operators import scenes as SC
from cropcube.sources.tables import read_dataset


def _feature(name, values, **more):
    props = {"datetime": "1997-05-06T16:45:00Z"} | {f"s2:{n}": v for n, v in zip(K.USABLE_AREA_PROPERTIES, values) if v != "absent"}
    return json.dumps({"id": name, "collection": "sentinel-2-l2a", "bbox": [-92, 34, -91, 35], "properties": props} | more)


def test_scenes_without_a_property_are_not_usable(spark):
    lines = [_feature("S2A_AF_19970506_1_L2A", [10, 10, 5, 5, 0]), _feature("S2A_AF_19970506_2_L2A", [10, 10, 5, 5, 0.001]),
             _feature("S2A_AF_19970506_3_L2A", [90, None, 0, 0, 0]), _feature("S2A_AF_19970506_4_L2A", [90, "absent", 0, 0, 0]),
             _feature("S2A_AF_19970506_5_L2A", [100, 0, 0, 0, 0], assets=None)]
    parsed = SC.parse_catalog(spark.createDataFrame([(x,) for x in lines], "json string"))
    got = {r.scene_id[-5:-4]: r.usable_area for r in SC.usable_scenes(parsed).collect()}
    assert got == {"2": 30.001, "5": 100.0}  # over 30, not equal; a missing or null share is not zero
    assert parsed.where("href_scl IS NULL").count() == 5


def test_splits_read_their_own_partitions(spark, tmp_path):
    rows = spark.range(60).select((F.col("id") % 3 + 1996).cast("int").alias("year"), F.lit("b").alias("bbox"), "id")
    rows.write.partitionBy("bbox", "year").parquet(str(tmp_path / "series"))
    stored = read_dataset(spark, str(tmp_path / "series"), schema="bbox string, year int, id long")
    splits = L.split_by_year(stored, {"train": 1996, "validation": 1997, "test": 1998})
    assert {n: d.count() for n, d in splits.items()} == {"train": 20, "validation": 20, "test": 20}
    for year, part in zip((1996, 1997, 1998), splits.values()):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "(year#" in plan.split("PartitionFilters: [")[1].split("]")[0] and str(year) in plan.split("PartitionFilters: [")[1].split("]")[0]
        scan = part.select("id").inputFiles()
        assert len(scan) > 0 and part.select(F.input_file_name().alias("f")).distinct().where(~F.col("f").contains(f"year={year}")).count() == 0


def test_catalogue_text_is_not_made_before_scenes_are_distinct(spark, sf_small):
    from cropcube.sources import fixtures as FX
    parsed = SC.parse_catalog(FX.scene_json(spark, sf_small)).where(F.col("collection") == FX.SCENE_COLLECTION)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "to_json" not in plan.split("Aggregate")[-1]
