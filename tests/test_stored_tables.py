"""Bucketed logs, checked writes, per-fold scaling, dictionaries, p-values."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import ts
from wardline.functions.pvalue import chi2_sf, log_gamma_half
from wardline.operators import features as X
from wardline.operators.aggregates import group_stats
from wardline.operators.indexing import range_index
from wardline.operators.matching import assign_controls, match_controls, write_matched
from wardline.sources.io import save_bucketed, save_checked


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_log_needs_no_exchange(spark):
    log = spark.range(5000).select((F.col("id") % 37).alias("k"), (F.col("id") * 1.5).alias("v"), F.lit("x").alias("pad"))
    stored = save_bucketed(log, "log", ["k"], 8)
    assert stored.count() == 5000
    keys = spark.createDataFrame([(k, k * 2) for k in range(20)], "k long, w long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = group_stats(stored.join(keys, "k"), "k", "v", "v")
        lines = _plan(out).split("\n")
        scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x)
        depth = len(re.match(r"[ :+\-|]*", lines[scan]).group())
        # Walk up from the scan: every line with a smaller indent is an ancestor.
        for line in reversed(lines[:scan]):
            d = len(re.match(r"[ :+\-|]*", line).group())
            if d < depth:
                depth = d
                assert "Exchange" not in line, line
        assert {r.k: r.v_max for r in out.collect()} == {r.k: r.m for r in log.where("k < 20").groupBy("k").agg(F.max("v").alias("m")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_checked_write(spark, tmp_path):
    schema = T.StructType.fromDDL("ID long, x double")
    df = spark.createDataFrame([(1, 2, "a"), (2, 3, "b")], "id int, x int, drop string")
    assert save_checked(df, str(tmp_path / "t"), schema, 2) == 2
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.schema == schema and sorted(map(tuple, back.collect())) == [(1, 2.0), (2, 3.0)]
    with pytest.raises(ValueError, match="2 rows, expected 3"):
        save_checked(df, str(tmp_path / "u"), schema, 3)
    assert save_checked(df.limit(0), str(tmp_path / "v"), schema, 0) == 0


def _arms(spark, n, m):
    cases = spark.createDataFrame([(k, float(k % 7)) for k in range(n)], "icustay_id long, sepsis_onset_hour double")
    controls = spark.createDataFrame([(1000 + k, ts("2024-01-01"), float(k % 11)) for k in range(m)],
                                     "icustay_id long, intime timestamp_ntz, length_of_stay double")
    return cases, controls


def test_matching_conserves_rows(spark, tmp_path):
    cases, controls = _arms(spark, 7, 53)
    schema = T.StructType.fromDDL("icustay_id long, control_onset_time timestamp_ntz, matched_case_icustay_id long")
    assert write_matched(cases, controls, str(tmp_path / "m"), schema) == 53
    assert spark.read.parquet(str(tmp_path / "m")).count() == match_controls(cases, controls).count() < 53
    every = assign_controls(cases, controls)
    assert every.count() == 53 and {r.n for r in every.groupBy("matched_case_icustay_id").agg(F.count("*").alias("n")).collect()} <= {7, 8}
    # Without cases the controls would vanish: the write says so.
    with pytest.raises(ValueError, match="0 controls were assigned"):
        write_matched(cases.limit(0), controls.unionByName(controls), str(tmp_path / "n"), schema)


def test_matching_raises_when_rows_are_lost(spark, tmp_path, monkeypatch):
    from wardline.operators import matching

    cases, controls = _arms(spark, 5, 20)
    whole = matching.assign_controls
    monkeypatch.setattr(matching, "assign_controls", lambda *a, **k: whole(*a, **k).where("icustay_id <> 1003"))
    with pytest.raises(ValueError, match="19 controls were assigned, expected 20"):
        write_matched(cases, controls, str(tmp_path / "m"), T.StructType.fromDDL("icustay_id long"))


def test_fold_scaling_leaves_its_own_fold_out(spark):
    r = random.Random(3)
    rows = [(k, k % 4 if k < 60 else None, r.uniform(-5, 5), None if k % 9 == 0 else float(k % 5), 2.0) for k in range(64)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, c double")
    got = X.fold_scale(df, ["a", "b", "c"], 4).collect()
    assert len(got) == 64 * 4
    for g in got:
        _, fold, *own = rows[g.id]
        for v, name, k in zip((g.a, g.b, g.c), "abc", range(3), strict=True):
            train = [x[2 + k] for x in rows if x[1] is not None and x[1] != g.model and x[2 + k] is not None]
            lo, hi = min(train), max(train)
            assert (v is None) if own[k] is None else v == pytest.approx((own[k] - lo) / ((hi - lo) or 1.0)), name
        assert g.is_valid == (fold == g.model)
    one = X.fold_scale(df.where("fold = 0"), ["a"], 1).collect()  # no other fold: nothing to scale with
    assert len(one) == 15 and all(x.a is None for x in one)


@pytest.mark.parametrize("rows_a_part", [7, 1_000_000])
def test_dictionary_of_values_with_one_prefix(spark, rows_a_part):
    words = [f"prefix-{k:05d}" for k in range(200)] + ["", "ä", "prefix-00001x"]
    df = spark.createDataFrame([(w,) for w in words * 3] + [(None,)], "w string")
    got = {r.w: r.i for r in range_index(df.where("w is not null").distinct(), ["w"], name="i", rows_a_part=rows_a_part).collect()}
    assert got == {w: k for k, w in enumerate(sorted(words, key=lambda x: x.encode()))}


def test_label_encode(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b"), (5, "c")], "id long, w string")
    assert {r.id: r.w for r in X.label_encode(df, "w").collect()} == {1: 1, 2: 0, 3: None, 4: 1, 5: 2}
    fit = spark.createDataFrame([("a",), ("b",)], "w string")
    assert {r.id: r.code for r in X.label_encode(df, "w", "code", fit).collect()} == {1: 1, 2: 0, 3: None, 4: 1, 5: None}


def test_chi_square_tail(spark):
    # Whole even dof: exp(-x/2) * sum of (x/2)^k / k!; dof 1: erfc(sqrt(x/2)); dof + 2 from dof by the recurrence.
    def tail(x, k):
        if k == 1:
            return math.erfc(math.sqrt(x / 2))
        if k == 2:
            return math.exp(-x / 2)
        return tail(x, k - 2) + math.exp((k / 2 - 1) * math.log(x / 2) - x / 2 - math.lgamma(k / 2))

    rows = [(float(x), k) for k in (1, 2, 3, 4, 5, 10, 31, 100) for x in (1e-6, 0.3, 1, 3.84, 9, 25, 60, 99, 140, 300)]
    df = spark.createDataFrame(rows, "x double, k long")
    for r in df.select("x", "k", chi2_sf("x", "k").alias("p"), log_gamma_half("k").alias("g")).collect():
        assert r.p == pytest.approx(tail(r.x, r.k), rel=1e-8, abs=1e-12), (r.x, r.k)
        assert r.g == pytest.approx(math.lgamma(r.k / 2))
    odd = spark.createDataFrame([(None, 1), (2.0, None), (2.0, 0), (0.0, 3), (-1.0, 3), (float("nan"), 2), (float("inf"), 2)], "x double, k long")
    got = [r.p for r in odd.select(chi2_sf("x", "k").alias("p")).collect()]
    assert got == [None, None, None, 1.0, 1.0, None, 0.0]
