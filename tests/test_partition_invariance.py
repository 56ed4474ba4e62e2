"""Results must not depend on how the input is partitioned."""

import random

from pyspark.sql import functions as F

from wardline.operators import aggregates as A
from wardline.operators import evaluate as V
from wardline.operators.cohort import detect_onset
from wardline.operators.indexing import global_index


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_invariance(spark):
    random.seed(11)
    data = [(random.randrange(40), float(random.randrange(100)), random.randrange(2)) for _ in range(1500)]
    df = spark.createDataFrame(data, "k long, x double, y int")
    for parts in (1, 7):
        d = df.repartition(parts)
        base = df.coalesce(1)
        assert _rows(global_index(d.withColumn("id", F.monotonically_increasing_id() * 0 + F.col("k") * 1000
                                               + F.col("x").cast("long")).dropDuplicates(["id"]), ["id"])
                     .select("id", "idx")) == \
            _rows(global_index(base.withColumn("id", F.col("k") * 1000 + F.col("x").cast("long"))
                               .dropDuplicates(["id"]), ["id"]).select("id", "idx"))
        assert _rows(V.roc_auc(d, "y", "x")) == _rows(V.roc_auc(base, "y", "x"))
        assert _rows(A.exact_quantiles(d, "x", [0.25, 0.5], group=["y"])) == \
            _rows(A.exact_quantiles(base, "x", [0.25, 0.5], group=["y"]))


def test_onset_invariance(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    random.seed(3)
    susp = spark.createDataFrame([(k, base + dt.timedelta(hours=100)) for k in range(20)],
                                 "icustay_id long, suspected_infection_time timestamp_ntz")
    sc = spark.createDataFrame([(random.randrange(20), base + dt.timedelta(hours=random.randrange(200)),
                                 random.randrange(5)) for _ in range(800)],
                               "icustay_id long, starttime timestamp_ntz, sofa_24hours int")
    sc = sc.withColumn("endtime", F.col("starttime"))
    a = _rows(detect_onset(sc.repartition(5), susp))
    b = _rows(detect_onset(sc.coalesce(1), susp))
    assert a == b and len(a) > 0
