import os
import tempfile

from pyspark.sql import types as T

from wardline.session import checkpoint_dir, materialize
from wardline.sources.io import load_csv, save_csv, save_with_schema


def test_csv_roundtrip_and_schema(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([(1, 2.5, "a", float("nan"))], "id long, x double, s string, n double")
    save_csv(df, os.path.join(d, "c"))
    back = load_csv(spark, os.path.join(d, "c"), "id long, x double, s string, n double").first()
    assert back.id == 1 and back.x == 2.5 and back.n is None
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("x", T.DoubleType())])
    save_with_schema(df, os.path.join(d, "t"), schema)
    assert spark.read.parquet(os.path.join(d, "t")).columns == ["ID", "x"]


def test_checkpoint_dir_and_materialize(spark):
    before = checkpoint_dir(spark)
    df = materialize(spark.range(10))
    assert df.count() == 10
    assert checkpoint_dir(spark) == before  # none is invented
