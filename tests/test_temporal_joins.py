import datetime as dt

from pyspark.sql import functions as F

from conftest import ts
from wardline.functions import temporal as T
from wardline.operators.joins import exclude, not_in, window_join

NTZ = "timestamp_ntz"


def test_boundary_semantics(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:59:59.900000"), ts("2024-01-01 11:01:00"))],
                               f"a {NTZ}, b {NTZ}")
    r = df.select(T.diff_hours_boundary("b", "a").alias("h"), T.diff_seconds("b", "a").alias("s"),
                  T.diff_days("b", "a").alias("d"), T.diff_years("b", "a").alias("y"),
                  F.timestamp_diff("HOUR", "a", "b").alias("elapsed")).first()
    assert r.h == 1 and r.elapsed == 0          # one boundary, zero elapsed hours
    assert r.s == 61                            # 10:59:59 -> 11:01:00 second boundaries
    assert r.d == 0 and r.y == 0


def test_add_fractional_hours(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00"), 1.5)], f"t {NTZ}, h double")
    assert df.select(T.add_fractional_hours("t", "h").alias("x")).first().x == ts("2024-01-01 01:30:00")
    assert df.select(T.add_hours("t", -48).alias("x")).first().x == ts("2023-12-30 00:00:00")


def _anchors(spark):
    return spark.createDataFrame([(1, ts("2024-01-10 12:00:00")), (2, ts("2024-01-10 12:00:00"))],
                                 f"k long, anchor {NTZ}")


def _events(spark):
    us = dt.timedelta(microseconds=1)
    a = ts("2024-01-10 12:00:00")
    lo = a - dt.timedelta(hours=48)
    rows = [(1, a, 1.0), (1, lo, 2.0), (1, a + us, 3.0), (1, lo - us, 4.0), (1, a - dt.timedelta(hours=30), 5.0)]
    return spark.createDataFrame(rows, f"k long, t {NTZ}, v double")


def test_window_join_ends_inclusive(spark):
    out = window_join(_anchors(spark), _events(spark), "k", "anchor", "t", 48, how="left")
    got = sorted((r.k, r.v) for r in out.collect())
    assert got == [(1, 1.0), (1, 2.0), (1, 5.0), (2, None)]   # anchor 2: one all-NULL row


def test_window_join_inner_and_shuffle_path(spark):
    out = window_join(_anchors(spark), _events(spark), "k", "anchor", "t", 48, how="inner",
                      broadcast_rows=0, bucket_hours=6)
    assert sorted(r.v for r in out.collect()) == [1.0, 2.0, 5.0]


def test_not_in_three_valued(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    sub = spark.createDataFrame([(1,)], "k long")
    sub_null = spark.createDataFrame([(1,), (None,)], "k long")
    empty = spark.createDataFrame([], "k long")
    assert sorted(r.k for r in not_in(df, "k", sub).collect()) == [2]
    assert not_in(df, "k", sub_null).count() == 0
    assert not_in(df, "k", empty).count() == 3


def test_exclude_drops_null(spark):
    df = spark.createDataFrame([(1, 20.0), (2, None), (3, 10.0)], "id long, age double")
    out = exclude(df, [F.col("age") <= 16])
    assert [r.id for r in out.collect()] == [1]


def test_window_join_after_hours(spark):
    anchors = spark.createDataFrame([(1, ts("2024-01-10 12:00:00"))], f"k long, anchor {NTZ}")
    ev = spark.createDataFrame([(1, ts("2024-01-10 17:00:00"), 1.0), (1, ts("2024-01-10 17:00:00.000001"), 2.0),
                                (1, ts("2024-01-09 12:00:00"), 3.0)], f"k long, t {NTZ}, v double")
    out = window_join(anchors, ev, "k", "anchor", "t", 0, how="inner", after_hours=5)
    assert [r.v for r in out.collect()] == [1.0]
