"""One-pass left interval join, stacked anchors, presence tests, merged hourly means."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardline.operators import aggregates as A
from wardline.operators.joins import outer_merge, window_join
from wardline.operators.measures import measure_series, measured_keys, stack_anchors
from wardline.plans import queries as Q
from wardline.plans import queries_features as QF
from wardline.plans.testbed import Testbed
from wardline.specs import LabelSpec

SMALL = "/root/testdata/sf0.001"
BASE = dt.datetime(2024, 1, 1)


def _data(seed, n=400):
    r = random.Random(seed)
    when = lambda: BASE + dt.timedelta(minutes=r.randrange(0, 60 * 24 * 9), microseconds=r.choice([0, 1, 999_999]))
    events = [(0 if i % 3 == 0 else r.randrange(8), when(), float(i)) for i in range(n)] + [(None, when(), -1.0), (1, None, -2.0)]
    anchors = [(k % 10, when(), r.choice([1.0, 24.0, 48.0, 96.0])) for k in range(40)]
    anchors += [anchors[0], (None, when(), 48.0), (2, None, 48.0), (3, when(), None)]
    # Both ends of the window, to the microsecond.
    k, a, h = anchors[5]
    for d in (dt.timedelta(0), dt.timedelta(hours=h), dt.timedelta(microseconds=-1), dt.timedelta(hours=h, microseconds=1)):
        events.append((k, a - d, 1000.0 + d.microseconds))
    return events, anchors


def _brute(events, anchors, hours, after=0.0):
    out = []
    for k, a, h in anchors:
        back = h if hours is None else hours
        hit = [] if k is None or a is None or back is None else [
            (k, a, h, t, v) for kk, t, v in events
            if kk == k and t is not None and a - dt.timedelta(hours=back) <= t <= a + dt.timedelta(hours=after)]
        out += hit or [(k, a, h, None, None)]
    return Counter(out)


@pytest.mark.parametrize("kw", [{}, {"broadcast_rows": 0}])
@pytest.mark.parametrize("hours, after", [(48, 0.0), ("h", 0.0), (0, 0.0), (6, 30.0)])
def test_left_join_equals_brute_force(spark, kw, hours, after):
    events, anchors = _data(3)
    ev = spark.createDataFrame(events, "k long, t timestamp_ntz, v double")
    an = spark.createDataFrame(anchors, "k long, a timestamp_ntz, h double")
    got = window_join(an, ev, "k", "a", "t", hours, how="left", after_hours=after, **kw)
    assert Counter(map(tuple, got.collect())) == _brute(events, anchors, None if hours == "h" else hours, after)
    inner = window_join(an, ev, "k", "a", "t", hours, how="inner", after_hours=after, **kw)
    want = Counter({k: n for k, n in _brute(events, anchors, None if hours == "h" else hours, after).items() if k[3] is not None})
    assert Counter(map(tuple, inner.collect())) == want


def test_left_join_without_anchors(spark):
    ev = spark.createDataFrame([(1, BASE, 1.0)], "k long, t timestamp_ntz, v double")
    an = spark.createDataFrame([], "k long, a timestamp_ntz")
    assert window_join(an, ev, "k", "a", "t", 48).count() == 0


def _scans(df, path) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet .*{re.escape(path)}", plan))


@pytest.mark.parametrize("kw", [{}, {"broadcast_rows": 0}])
def test_left_join_reads_the_events_once(spark, tmp_path, kw):
    events, anchors = _data(4)
    spark.createDataFrame(events, "k long, t timestamp_ntz, v double").write.parquet(str(tmp_path / "log"))
    an = spark.createDataFrame(anchors, "k long, a timestamp_ntz, h double").drop("h")
    out = window_join(an, spark.read.parquet(str(tmp_path / "log")), "k", "a", "t", 48, **kw)
    assert _scans(out, "/log") == 1
    spec = LabelSpec([(1, "A")], [], ["A"], [])
    lab = spark.read.parquet(str(tmp_path / "log")).withColumns({"itemid": F.lit(1), "valuenum": F.col("v")})
    series = measure_series(an.withColumnsRenamed({"k": "icustay_id"}).withColumn("subject_id", F.lit(1)), lab, spec, keys={"icustay_id": "k"},
                            anchor_col="a", time_col="t", hours=48, **kw)
    assert _scans(series, "/log") == 1


def _events_read(df) -> int:
    """Scans of the event table that are left in the plan (shared ones count once)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"FileScan parquet .*events\.parquet", plan))


def test_event_scans_of_the_queries(spark):
    for name in ("lab_series_case_48h", "lab_series_control_96h", "lab_series_all", "vital_series_all"):
        assert _events_read(QF.QUERIES[name](spark, SMALL)) == 1, name
    assert _events_read(QF.QUERIES["sequence_frame"](spark, SMALL)) <= 2


def test_stacked_series_hold_every_single_series(spark):
    tb = Testbed(spark, SMALL)
    for kind, stacked in (("lab", Q.both_labs(tb, (48, 96))), ("vital", Q.both_vitals(tb, (48, 96)))):
        stacked = stacked.cache()
        for arm, label in (("case", 1), ("control", 0)):
            for hours in (48, 96):
                want = QF.QUERIES[f"{kind}_series_{arm}_{hours}h"](spark, SMALL)
                got = stacked.where((F.col("label") == label) & (F.col("horizon") == hours)).select(*want.columns)
                assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), (kind, arm, hours)


def test_stack_anchors_keeps_every_row(spark):
    a = spark.createDataFrame([(1, BASE), (1, BASE), (2, None)], "id long, at timestamp_ntz")
    b = spark.createDataFrame([(3, BASE)], "id long, onset timestamp_ntz")
    got = stack_anchors([(a, "at", {"arm": "x"}), (b, "onset", {"arm": "y"})], (48, 96)).select("id", "anchor_time", "arm", "horizon").collect()
    want = [(i, t, "x", h) for i, t in ((1, BASE), (1, BASE), (2, None)) for h in (48, 96)] + [(3, BASE, "y", h) for h in (48, 96)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_measured_keys_equal_the_wide_series(spark):
    tb = Testbed(spark, SMALL)
    labs, vits = Q.with_measurements(tb)
    for got, wide in ((labs, Q.both_labs(tb).where("chart_time is not null")), (vits, Q.both_vitals(tb))):
        rows = got.collect()
        assert len(rows) == len(set(map(tuple, rows))) > 0
        assert {tuple(r) for r in rows} == {tuple(r) for r in wide.select("label", "subject_id").distinct().collect()}


def test_merged_hours_equal_the_outer_join(spark):
    a = spark.createDataFrame([(1, 0, 1.0, None), (1, 0, 2.0, 4.0), (1, 2, None, None), (2, 1, 5.0, 6.0)], "k long, hr long, x double, y double")
    b = spark.createDataFrame([(1, 0, 7.0), (1, 1, 8.0), (3, 0, None)], "k long, hr long, z double")
    got = A.hourly_mean_all({"a": (a, ["x", "y"]), "b": (b, ["z"])}, "k", "hr")
    want = outer_merge([A.hourly_mean(a, "k", "hr", ["x", "y"]), A.hourly_mean(b, "k", "hr", ["z"])], ["k", "hr"])
    assert Counter(map(tuple, got.drop("has_a", "has_b").collect())) == Counter(map(tuple, want.select("k", "hr", "x", "y", "z").collect()))
    flags = {(r.k, r.hr): (r.has_a, r.has_b) for r in got.collect()}
    assert flags == {(1, 0): (1, 1), (1, 2): (1, 0), (2, 1): (1, 0), (1, 1): (0, 1), (3, 0): (0, 1)}
