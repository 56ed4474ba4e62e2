"""Queries over cases and controls together, on the smallest test tables."""

import pytest
from pyspark.sql import functions as F

from wardline.plans import queries_features as Q
from wardline.plans.testbed import Testbed

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stacked(spark):
    return Q.QUERIES["static_measure_merge_arms"](spark, SMALL).toPandas()


def test_both_arms_and_all_measures(spark, stacked):
    assert set(stacked.label) == {0, 1} and len(Q.MEASURE_FEATS) == 39
    for c in Q.LAB_COLS + Q.VIT_COLS:
        assert {f"{c}_mean", f"{c}_median", f"{c}_std"} <= set(stacked.columns)
    kept = [c for c in Q.MEASURE_FEATS if stacked[c].notna().mean() >= 0.5]
    got = Q.QUERIES["drop_sparse"](spark, SMALL)
    assert [c for c in got.columns if c in Q.MEASURE_FEATS] == kept and got.count() == len(stacked)


def test_medians_are_those_of_both_arms(spark, stacked):
    got = Q.QUERIES["impute_median_arms"](spark, SMALL).toPandas()
    for c in Q.MEASURE_FEATS:
        want = stacked[c].fillna(stacked[c].median())
        assert sorted(got[c].dropna()) == pytest.approx(sorted(want.dropna()), abs=2e-6)


def test_linear_models_see_every_measure(spark):
    train, test, features = Q.measured_frames(Testbed(spark, SMALL))
    assert set(Q.MEASURE_FEATS) < set(features) and set(Q.MODEL_FEATURES) < set(features)
    both = train.unionByName(test)
    assert both.select(*[F.count(F.when(F.col(c).isNull() | F.isnan(c), 1)).alias(c) for c in features]).first().asDict() == dict.fromkeys(features, 0)
    assert train.agg(F.countDistinct("label")).first()[0] == 2
