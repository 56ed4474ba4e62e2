import numpy as np

from wardline.operators import evaluate as V


def _df(spark, ys, ps):
    return spark.createDataFrame([(int(y), float(p)) for y, p in zip(ys, ps)], "y int, p double")


def brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y != 1]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_ties_perfect_reversed(spark):
    rng = np.random.default_rng(0)
    ys = rng.integers(0, 2, 300)
    ps = np.round(rng.random(300), 1)            # heavy ties
    assert abs(V.roc_auc(_df(spark, ys, ps), "y", "p").first().roc_auc - brute_auc(ys, ps)) < 1e-12
    assert V.roc_auc(_df(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]), "y", "p").first().roc_auc == 1.0
    assert V.roc_auc(_df(spark, [1, 1, 0, 0], [0.1, 0.2, 0.8, 0.9]), "y", "p").first().roc_auc == 0.0


def test_auc_invariant_under_sigmoid(spark):
    rng = np.random.default_rng(1)
    ys = rng.integers(0, 2, 100)
    ps = rng.normal(size=100)
    a = V.roc_auc(_df(spark, ys, ps), "y", "p").first().roc_auc
    b = V.roc_auc(_df(spark, ys, 1 / (1 + np.exp(-ps))), "y", "p").first().roc_auc
    assert abs(a - b) < 1e-12


def test_roc_curve_points(spark):
    df = _df(spark, [1, 0, 1, 0, 0], [0.9, 0.8, 0.7, 0.7, 0.1])
    pts = sorted((r.fpr, r.tpr) for r in V.roc_curve(df, "y", "p").collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    assert all(b[1] >= a[1] for a, b in zip(pts, pts[1:]))


def test_pr_curve_full_recall_cut(spark):
    # full recall reached at 0.7; the lower threshold 0.1 is not a point
    df = _df(spark, [1, 0, 1, 0, 0], [0.9, 0.8, 0.7, 0.7, 0.1])
    pts = sorted((r.threshold if r.threshold is not None else -1, r.recall, r.precision)
                 for r in V.pr_curve(df, "y", "p").collect())
    assert pts == [(-1, 0.0, 1.0), (0.7, 1.0, 0.5), (0.8, 0.5, 0.5), (0.9, 0.5, 1.0)]
    area = V.pr_auc(df, "y", "p").first().pr_auc
    # trapezoids: (0,1)-(0.5,1) ; (0.5,1)-(0.5,0.5) ; (0.5,0.5)-(1,0.5)
    assert abs(area - (0.5 * 1.0 + 0.0 + 0.5 * 0.5)) < 1e-12


def test_threshold_metrics(spark):
    r = V.threshold_metrics(_df(spark, [1, 1, 0, 0], [0.9, 0.4, 0.6, 0.1]), "y", "p").first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.5, 0.5, 0.5)


def test_curve_auc_known_value(spark):
    # hand-made stored curve: square-ish ROC with a diagonal step
    pts = [(0, 0.0, 0.0), (1, 0.0, 0.5), (2, 0.5, 0.5), (3, 0.5, 1.0), (4, 1.0, 1.0)]
    df = spark.createDataFrame(pts, "i long, x double, y double")
    assert abs(V.curve_auc(df, "i", "x", "y").first().auc - 0.75) < 1e-12
