from pyspark.sql import functions as F

from conftest import ts
from wardline.operators.cohort import detect_onset, first_per_key
from wardline.operators.measures import bound_values, classify_items, convert_units, measure_series
from wardline.specs import LabelSpec, RuleSpec, vital_series_spec

NTZ = "timestamp_ntz"


def test_detect_onset_first_crossing_and_window(spark):
    susp = spark.createDataFrame([(1, ts("2024-01-05 10:30:00")), (2, ts("2024-01-05 10:00:00")),
                                  (3, None)], f"icustay_id long, suspected_infection_time {NTZ}")
    rows = [
        (1, ts("2024-01-03 10:00:00"), 5),   # -48 boundaries exactly: inside
        (1, ts("2024-01-04 00:00:00"), 3),   # later crossing
        (1, ts("2024-01-03 09:59:00"), 9),   # -49: outside
        (2, ts("2024-01-05 11:00:00"), 1),   # no crossing
        (3, ts("2024-01-05 11:00:00"), 5),   # no suspicion
    ]
    sc = spark.createDataFrame(rows, f"icustay_id long, starttime {NTZ}, sofa_24hours int")
    sc = sc.withColumn("endtime", F.col("starttime"))
    out = detect_onset(sc, susp).collect()
    assert [(r.icustay_id, r.sepsis_onset, r.sofa_24hours) for r in out] == [
        (1, ts("2024-01-03 10:00:00"), 5)]


def test_first_per_key_ties(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c")], "k long, t long, v string")
    assert first_per_key(df, "k", "t").first().v == "a"


def test_bounds_and_rules(spark):
    df = spark.createDataFrame([(50862, 10.0), (50862, 10.5), (51144, -1.0), (51144, None), (999, 1e9)],
                               "itemid long, v double")
    spec = [(50862, None, 10), (51144, 0, 100)]
    got = [r.x for r in df.select(bound_values("itemid", "v", spec).alias("x")).collect()]
    assert got == [10.0, None, None, None, 1e9]
    vs = vital_series_spec()
    v = spark.createDataFrame([(223761, 98.6), (223762, 37.0), (220277, 100.0), (220277, 100.5),
                               (228376, None)], "itemid long, v double")
    r = v.select(classify_items("itemid", "v", vs.rules).alias("m"),
                 convert_units("itemid", "v", vs.fahrenheit).alias("c")).collect()
    assert [x.m for x in r] == [6, 6, 7, None, 13]
    assert abs(r[0].c - 37.0) < 1e-9 and r[1].c == 37.0


def test_measure_series_left_keeps_empty_anchor(spark):
    anchors = spark.createDataFrame([(1, 10, ts("2024-01-03 00:00:00")), (2, 20, ts("2024-01-03 00:00:00"))],
                                    f"icustay_id long, subject_id long, onset {NTZ}")
    ev = spark.createDataFrame([(10, 1, ts("2024-01-02 00:00:00"), 5.0), (10, 1, ts("2024-01-02 01:00:00"), 0.0),
                                (10, 2, ts("2024-01-02 02:00:00"), 50.0), (10, 3, ts("2024-01-02 03:00:00"), 7.0)],
                               f"subject_id long, itemid long, charttime {NTZ}, valuenum double")
    spec = LabelSpec([(1, "A"), (2, "B")], [(2, None, 40)], ["A", "B"], [3])
    out = measure_series(anchors, ev, spec, keys="subject_id", anchor_col="onset", time_col="charttime", hours=48)
    got = sorted(((r.icustay_id, r.A, r.B) for r in out.collect()), key=repr)
    # value 0 dropped (> 0 rule), 50 above bound -> NULL, unlabelled item 3 dropped, anchor 2 kept
    assert got == sorted([(1, None, None), (1, 5.0, None), (2, None, None)], key=repr)
    assert out.columns == ["icustay_id", "subject_id", "chart_time", "A", "B"]


def test_rule_spec_inner(spark):
    anchors = spark.createDataFrame([(1, ts("2024-01-03 00:00:00"))], f"icustay_id long, onset {NTZ}")
    ev = spark.createDataFrame([(1, 223761, ts("2024-01-02 00:00:00"), 98.6, 0),
                                (1, 220045, ts("2024-01-02 00:00:00"), 80.0, 1)],
                               f"icustay_id long, itemid long, charttime {NTZ}, valuenum double, error int")
    spec = RuleSpec([((223761,), 70, False, 120, False, 6), ((220045,), 0, False, 300, False, 1)],
                    [223761, 220045], [(6, "TempC"), (1, "HeartRate")], [223761])
    out = measure_series(anchors, ev, spec, keys="icustay_id", anchor_col="onset", time_col="charttime",
                         hours=48, keep=("icustay_id",), event_filter=F.col("error") == 0).collect()
    assert len(out) == 1 and abs(out[0].TempC - 37.0) < 1e-9 and out[0].HeartRate is None


def test_detect_onset_upper_boundary(spark):
    susp = spark.createDataFrame([(1, ts("2024-01-05 10:30:00")), (2, ts("2024-01-05 10:30:00"))],
                                 f"icustay_id long, suspected_infection_time {NTZ}")
    rows = [(1, ts("2024-01-06 10:59:59"), 4),     # +24 hour boundaries: inside
            (2, ts("2024-01-06 11:00:00"), 4)]     # +25: outside
    sc = spark.createDataFrame(rows, f"icustay_id long, starttime {NTZ}, sofa_24hours int")
    sc = sc.withColumn("endtime", F.col("starttime"))
    assert [r.icustay_id for r in detect_onset(sc, susp).collect()] == [1]
