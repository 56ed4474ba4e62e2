import math

import numpy as np
from pyspark.sql import functions as F

from wardline.functions.scalar import recode_contains
from wardline.operators import aggregates as A
from wardline.operators import features as X


def test_panel_stats_null_rules(spark):
    ev = spark.createDataFrame([(1, 10, 5.0, "x"), (1, 20, None, "y"), (2, 10, 3.0, "z"), (2, 10, 5.0, None)],
                               "subject_id long, itemid long, valuenum double, value string")
    dic = spark.createDataFrame([(10, "WBC count"), (20, "Anion Gap")], "itemid long, label string")
    panels = [("wbc", "like", "wbc", "valuenum"), ("anion_gap", "in", "Anion Gap", "value")]
    got = {r.subject_id: r for r in A.panel_stats(ev, dic, panels).collect()}
    assert got[1].wbc_stddev == 0.0 and got[1].wbc_avg == 5.0          # n = 1 -> 0
    assert got[1].anion_gap_avg is None and got[1].anion_gap_stddev == 0.0   # text but no number
    assert got[2].anion_gap_stddev is None                              # absent panel -> NULL
    assert abs(got[2].wbc_stddev - math.sqrt(2.0)) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    vals = [float(v) for v in [5, 1, 3, 3, 9, 2, 8, 8, 8, 4, 7]]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "x double, g int")
    r = A.exact_quantiles(df, "x", [0.25, 0.5, 0.75], names=["a", "b", "c"]).first()
    assert np.allclose([r.a, r.b, r.c], np.percentile(vals, [25, 50, 75]))
    grouped = {x.g: x.m for x in A.exact_quantiles(df, "x", [0.5], group=["g"], names=["m"]).collect()}
    for g in (0, 1):
        assert grouped[g] == np.median([v for i, v in enumerate(vals) if i % 2 == g])


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0, None), (None, 4.0), (3.0, 2.0), (5.0, None)], "a double, b double")
    got = [(r.a, r.b) for r in A.impute_median(df, ["a", "b"]).collect()]
    assert got == [(1.0, 3.0), (3.0, 4.0), (3.0, 2.0), (5.0, 3.0)]


def test_chi2_and_kruskal_by_hand(spark):
    rows = [("F", "Yes")] * 10 + [("M", "Yes")] * 20 + [("F", "No")] * 30 + [("M", "No")] * 15
    df = spark.createDataFrame(rows, "gender string, grp string")
    obs = np.array([[10, 30], [20, 15]], dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    d = exp - obs
    corr = obs + np.sign(d) * np.minimum(0.5, np.abs(d))
    want = ((corr - exp) ** 2 / exp).sum()
    r = A.chi2_stat(df, "gender", "grp").first()
    assert r.dof == 1 and abs(r.statistic - want) < 1e-9
    vals = [(1.0, "a"), (2.0, "a"), (2.0, "b"), (3.0, "b"), (4.0, "b"), (4.0, "a"), (5.0, "c"), (6.0, "c")]
    kdf = spark.createDataFrame(vals, "v double, g string")
    # brute force
    xs = sorted(v for v, _ in vals)
    rank = {v: np.mean([i + 1 for i, x in enumerate(xs) if x == v]) for v in set(xs)}
    n = len(vals)
    groups = {}
    for v, g in vals:
        groups.setdefault(g, []).append(rank[v])
    h = 12 / (n * (n + 1)) * sum(sum(r) ** 2 / len(r) for r in groups.values()) - 3 * (n + 1)
    ties = sum(xs.count(v) ** 3 - xs.count(v) for v in set(xs))
    h /= 1 - ties / (n ** 3 - n)
    k = A.kruskal_stat(kdf, "v", "g").first()
    assert k.dof == 2 and abs(k.statistic - h) < 1e-9
    p = spark.createDataFrame([(3.841458820694124, 1), (5.991464547107979, 2)], "x double, k long")
    ps = [r.p for r in p.select(A.chi2_pvalue(F.col("x"), F.col("k")).alias("p")).collect()]
    assert np.allclose(ps, [0.05, 0.05])


def test_recode_last_match_wins(spark):
    df = spark.createDataFrame([("WHITE",), ("BLACK/AFRICAN",), ("ASIAN - CHINESE",), ("HISPANIC OR LATINO",),
                                ("WHITE - HISPANIC",), ("UNKNOWN",), (None,)], "e string")
    out = [r.x for r in df.select(recode_contains("e", ["WHITE", "BLACK", "ASIAN", "HISPANIC"], "OTHER")
                                  .alias("x")).collect()]
    assert out == ["White", "Black", "Asian", "Hispanic", "Hispanic", "Other", "Other"]


def test_forward_fill(spark):
    rows = [(1, 1, None), (1, 2, 5.0), (1, 4, None), (1, 5, 7.0), (2, 1, None), (2, 2, None)]
    df = spark.createDataFrame(rows, "k long, h long, v double")
    got = sorted((r.k, r.h, r.v) for r in X.forward_fill(df, "k", "h", ["v"]).collect())
    assert got == [(1, 1, 0.0), (1, 2, 5.0), (1, 4, 5.0), (1, 5, 7.0), (2, 1, 0.0), (2, 2, 0.0)]


def test_minmax(spark):
    train = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0), (None, 3.0)], "a double, c double")
    test = spark.createDataFrame([(5.0, 4.0), (None, 3.0)], "a double, c double")
    st = X.minmax_fit(train, ["a", "c"])
    got = [(r.a, r.c) for r in X.minmax_apply(test, st, ["a", "c"]).collect()]
    assert got == [(2.0, 1.0), (None, 0.0)]


def test_folds_and_split(spark):
    df = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "id long, y int")
    f = X.stratified_folds(df, "id", "y", 5, seed=42).collect()
    assert sorted(r.id for r in f) == list(range(200))
    for y in (0, 1):
        sizes = [sum(1 for r in f if r.y == y and r.fold == k) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1
    s = X.stratified_split(df, "id", "y", 0.1, seed=42).collect()
    n1 = sum(1 for r in s if r.y == 1)
    assert sum(1 for r in s if r.y == 1 and r.is_test) == round(n1 * 0.1)


def test_sequences_and_padding(spark):
    rows = [(1, 1, 1.0), (1, 0, 2.0), (2, 0, 3.0), (3, 5, 4.0), (3, 6, 5.0), (3, 7, 6.0)]
    df = spark.createDataFrame(rows, "k long, h long, v double")
    seqs = X.assemble_sequences(df, "k", "h", ["v"])
    got = {r.k: r.seq for r in seqs.collect()}
    assert got[1] == [[0.0, 2.0], [1.0, 1.0]]
    pad = X.pad_sequences(seqs, "k", batch_size=8).collect()
    assert all(len(r.padded) == 3 for r in pad)
    assert {r.k: r.pos for r in pad} == {3: 0, 1: 1, 2: 2}
