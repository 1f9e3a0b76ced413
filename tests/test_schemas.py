"""Fixture views and operator outputs conform to the declared schemas."""

import pytest

from cropcube import schemas as SC
from cropcube.operators import loader as L
from cropcube.operators.series import build_series, encode_series
from cropcube.sources import fixtures as FX
from cropcube.sources.tables import check_schema


def test_views_match_schemas(spark, sf_small):
    obs = FX.observations(spark, sf_small)
    check_schema(obs, SC.OBSERVATIONS)
    check_schema(FX.raster_strips(spark, sf_small), SC.RASTER_STRIPS, exact=True)
    check_schema(FX.scenes(spark, sf_small), SC.SCENES, exact=True)
    check_schema(FX.class_dictionary(spark), SC.CLASS_DICTIONARY, exact=True)
    ser = build_series(obs)
    check_schema(encode_series(ser), SC.SERIES_ENCODED, exact=True)
    check_schema(L.slots_long(L.training_examples(ser)), SC.SLOTS_LONG)


def test_check_schema_fails_early(spark):
    df = spark.createDataFrame([(1,)], "code LONG")
    with pytest.raises(ValueError, match="code"):
        check_schema(df, SC.CLASS_DICTIONARY)
