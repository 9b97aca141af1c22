import pytest
from pyspark.sql import functions as F

from landweave.functions import reproject as R


def test_published_example_of_the_projection(spark):
    # 52 39' 27.2531" N, 1 43' 4.5177" E on the Airy ellipsoid is 651409.903, 313177.270.
    df = spark.range(1).select(F.radians(F.lit(52 + 39 / 60 + 27.2531 / 3600)).alias("phi"), F.radians(F.lit(1 + 43 / 60 + 4.5177 / 3600)).alias("lam"))
    for name, step in R.grid_steps():
        df = df.withColumn(name, F.expr(step))
    got = df.first()
    assert abs(got.east - 651409.903) < 0.01 and abs(got.north - 313177.270) < 0.01


def test_degrees_to_the_grid(spark):
    df = spark.createDataFrame([(52.657977, 1.716038), (None, 1.0)], "lat double, lon double")
    near, none = R.to_grid(df, "lat", "lon").orderBy(F.desc_nulls_last("lat")).collect()
    assert abs(near.east - 651409.9) < 5 and abs(near.north - 313177.3) < 5 and none.east is None
    assert R.to_grid(df, "lat", "lon", 27700).first().east == 1.716038
    with pytest.raises(ValueError):
        R.to_grid(df, "lat", "lon", 3857)
