"""Cases that once lost rows or failed: NULL groups, clashing names, infinities, exact slices."""

import pytest

from wardline.operators import aggregates as A
from wardline.operators import evaluate as E
from wardline.operators import features as X
from wardline.operators.joins import window_join
from wardline.operators.matching import match_controls
from wardline.specs import HOURLY_LAB_BOUNDS, HOURLY_LAB_ITEMS, HOURLY_LAB_LABELS, hourly_lab_spec
from conftest import ts


def test_null_labels_stay_in_folds_and_splits(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "id long, label int")
    assert X.stratified_folds(df, "id", "label", 5).count() == 100
    assert X.stratified_split(df, "id", "label", 0.3).count() == 100


def test_null_group_has_quantiles(spark):
    df = spark.createDataFrame([(None if i < 3 else "a", float(i)) for i in range(9)], "g string, x double")
    got = {r.g: r.m for r in A.exact_quantiles(df, "x", [0.5], group=["g"], names=["m"]).collect()}
    assert got == {None: 1.0, "a": 5.5}


def test_infinite_scores(spark):
    rows = [(1, float("inf")), (0, float("-inf")), (1, 0.7), (0, 0.2), (0, 0.9)]
    df = spark.createDataFrame(rows, "y int, p double")
    assert E.roc_auc(df, "y", "p").first()[0] == pytest.approx(5 / 6)


def test_one_class_is_an_error(spark):
    with pytest.raises(ValueError, match="both classes"):
        E.classification_metrics(spark.createDataFrame([(1, 0.4), (1, 0.6)], "y int, p double"), "y", "p")


def test_clashing_event_columns(spark):
    a = spark.createDataFrame([(1, ts("2020-01-02T00:00:00"), "A")], "k int, t timestamp_ntz, note string")
    e = spark.createDataFrame([(1, ts("2020-01-01T12:00:00"), "E"), (1, ts("2019-01-01T12:00:00"), "old")],
                              "k int, at timestamp_ntz, note string")
    with pytest.raises(ValueError, match="note"):
        window_join(a, e, "k", "t", "at", 48)
    row = window_join(a, e, "k", "t", "at", 48, suffix="_event").collect()
    assert [(r.note, r.note_event) for r in row] == [("A", "E")]


def test_window_join_prunes_event_time(spark, tmp_path):
    e = spark.createDataFrame([(1, ts("2020-01-01T12:00:00"))], "k int, at timestamp_ntz")
    e.write.parquet(str(tmp_path / "e"))
    a = spark.createDataFrame([(1, ts("2020-01-02T00:00:00"))], "k int, t timestamp_ntz")
    plan = window_join(a, spark.read.parquet(str(tmp_path / "e")), "k", "t", "at", 48)._jdf.queryExecution().toString()
    pushed = plan[plan.rindex("PushedFilters"):][:300]
    assert "GreaterThanOrEqual(at" in pushed and "LessThanOrEqual(at" in pushed


def test_every_hourly_item_has_a_label():
    assert len(HOURLY_LAB_LABELS) == 26 == len(HOURLY_LAB_BOUNDS)
    assert {i for i, _ in HOURLY_LAB_LABELS} == set(HOURLY_LAB_ITEMS)
    assert len({x for _, x in HOURLY_LAB_LABELS}) == 19 and not hourly_lab_spec().extra_items


def test_repeated_control_ids_are_all_matched(spark):
    cases = spark.createDataFrame([(1, 0.5), (2, 0.5)], "icustay_id long, sepsis_onset_hour double")
    t = ts("2020-01-01T00:00:00")
    controls = spark.createDataFrame([(10, t, 9.0), (10, t, 8.0), (11, t, 9.0), (12, t, 9.0)],
                                     "icustay_id long, intime timestamp_ntz, length_of_stay double")
    got = match_controls(cases, controls).collect()
    assert len(got) == 4 and {r.matched_case_icustay_id for r in got} == {1, 2}
