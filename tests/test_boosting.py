"""Boosted trees against exhaustive search, and the search over their parameters."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardline.operators import boosting as B
from wardline.operators import evaluate as V


def _frame(n=300, seed=0, folds=5):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + r.normal(scale=0.5, size=n) > 0.5).astype(float)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0.05, 0.95, 15))) for k in range(4)]
    bins = np.stack([B.bin_values(x[:, k], edges[k]) for k in range(4)], 1)
    return B.BinnedFrame(list("abcd"), edges, bins, y, np.arange(n) % folds)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 4)), min_size=1, max_size=60))
def test_auc_equals_all_pairs(rows):
    y, s = (np.array(v, float) for v in zip(*rows, strict=True))
    pairs = [(1.0 if a > b else 0.5 if a == b else 0.0) for a in s[y > 0] for b in s[y == 0]]
    assert B.auc(y, s) == pytest.approx(np.mean(pairs) if pairs else 0.5)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(45, 120))
def test_first_split_is_the_best_of_all(seed, n):
    r = np.random.default_rng(seed)
    bins = r.integers(0, 5, (n, 3)).astype(np.uint8)
    grad, hess = r.normal(size=n), r.uniform(0.05, 0.25, n)
    best = 0.0
    for f in range(3):
        for cut in range(4):
            left = bins[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= B.MIN_ROWS:
                gain = sum(grad[m].sum() ** 2 / hess[m].sum() for m in (left, ~left)) - grad.sum() ** 2 / hess.sum()
                best = max(best, gain)
    nodes = B.grow(bins, grad, hess, np.arange(3), num_leaves=2, max_depth=3)
    if best <= 1e-12:
        assert len(nodes) == 1
        return
    assert nodes[0][5] == pytest.approx(best)
    left = bins[:, nodes[0][0]] <= nodes[0][1]
    assert [x[6] for x in nodes] == [n, left.sum(), (~left).sum()]
    want = np.where(left, -grad[left].sum() / hess[left].sum(), -grad[~left].sum() / hess[~left].sum())
    assert B.tree_values(nodes, bins) == pytest.approx(want)


def test_leaves_depth_and_rows_are_bounded():
    f = _frame(2000)
    p = np.full(2000, f.label.mean())
    for leaves, depth in ((2, 11), (7, 2), (21, 11)):
        nodes = B.grow(f.bins, p - f.label, p * (1 - p), np.arange(4), leaves, depth)
        ends = [x for x in nodes if x[0] < 0]
        assert len(ends) <= min(leaves, 2**depth) and all(x[6] >= B.MIN_ROWS for x in ends) and sum(x[6] for x in ends) == 2000
    assert len(B.grow(f.bins, p - f.label, p * (1 - p), np.arange(4), 21, 11)) > 21


def test_missing_values_have_the_lowest_bin():
    assert B.bin_values(np.array([np.nan, -5.0, 1.0, 1.5, 2.0, 9.0]), np.array([1.0, 2.0])).tolist() == [0, 1, 1, 2, 2, 3]


def test_draws_stay_in_the_space():
    draws = B.sample_space(200, 7)
    assert draws == B.sample_space(200, 7) != B.sample_space(200, 8)
    for name, (low, high, step) in B.SPACE.items():
        seen = [d[name] for d in draws]
        assert low <= min(seen) and max(seen) <= high
        assert (set(seen) == set(range(low, high + 1))) if step else len(set(seen)) > 190


def test_stopping_waits_for_the_mean_to_rise():
    f = _frame(400, 1)
    params = {"num_leaves": 6, "learning_rate": 0.1, "feature_fraction": 0.5, "max_depth": 3}
    whole = B.cross_validate(f, params, 5, rounds=120, patience=10**6, seed=3).mean(1)
    for patience in (1, 5, 20):
        got = B.cross_validate(f, params, 5, rounds=120, patience=patience, seed=3).mean(1)
        full = B.cross_validate(f, params, 5, rounds=120, patience=10**6, seed=3)
        mean, best = [], 0
        for r, v in enumerate(_means(f, params, 120)):
            mean.append(v)
            if v > mean[best]:
                best = r
            elif r - best >= patience:
                break
        assert len(got) == best + 1 and got == pytest.approx(mean[:best + 1])
        assert len(full) == len(whole)
    assert whole[-1] == max(whole)


def _means(f, params, rounds):
    models = [B._Booster(f, k, params, 3) for k in range(5)]
    for _ in range(rounds):
        for m in models:
            m.step()
        yield float(np.mean([m.held_out_auc() for m in models]))


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(5)
    rows = [(k, float(x[0]), None if k % 11 == 0 else float(x[1]), float(k % 3), int(x[0] + 0.4 * x[1] > 0.3))
            for k, x in enumerate(r.normal(size=(420, 2)))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int")


def test_search_fit_predict(spark, data):
    features = ["a", "b", "c"]
    frame = B.binned_frame(data, features, folds=3)
    assert frame.bins.shape == (420, 3) and set(frame.fold) == {0, 1, 2} and (frame.bins[:, 1] == 0).sum() == 39
    results = B.search(spark, frame, B.sample_space(6, 1), folds=3, rounds=40, patience=8, seed=2).cache()
    rows = results.orderBy("trial").collect()
    assert [r.trial for r in rows] == list(range(6))
    for r in rows:
        mean = np.array(r.aucs).mean(1)
        assert len(mean) == r.rounds <= 40 and r.score == pytest.approx(mean.mean(), abs=1e-5) and mean.argmax() == r.rounds - 1
    best = B.best_trial(results)
    assert best["score"] == max(r.score for r in rows) > 0.9
    nodes = B.fit_folds(spark, frame, best, folds=3, rounds=best["rounds"], seed=2).cache()
    p = B.predict_folds(data, nodes, frame, "id")
    assert p.columns == [*data.columns, "p"] and p.count() == 420
    assert p.where("p < 0 or p > 1 or p is null").count() == 0
    assert V.roc_auc(p, "label", "p").first().roc_auc > 0.95
    # The held-out AUC of the last round is that of the saved trees.
    for fold in range(3):
        held = np.flatnonzero(frame.fold == fold)
        score = np.zeros(420)
        for r in range(best["rounds"] + 1):
            tree = nodes.where((F.col("fold") == fold) & (F.col("round") == r)).orderBy("node").collect() if r < 3 else None
            if tree is None:
                break
            score += B.tree_values([(n.feature, n.bin, n.left, n.right, n.value) for n in tree], frame.bins)
        assert B.auc(frame.label[held], score[held]) == pytest.approx(best["aucs"][min(2, best["rounds"]) - 1][fold])


def test_sampled_rows_are_bounded(spark, data):
    frame = B.binned_frame(data, ["a"], folds=3, max_rows=50)
    assert frame.bins.shape == (50, 1) and len(frame.edges[0]) > 40


def test_every_row_of_a_large_frame_counts(spark):
    df = spark.range(120_000).selectExpr("id", "if(id % 7 = 0, null, cast(id % 13 as double)) a", "double(id % 3) b", "int(id % 5 = 0) label")
    frame = B.binned_frame(df, ["a", "b"], folds=3)
    assert frame.count.sum() == 120_000 and (frame.count * frame.label).sum() == 24_000 and len(frame.bins) == 14 * 3 * 2 * 3
    assert frame.count[frame.bins[:, 0] == 0].sum() == 17_143
    each = [frame.count[(frame.fold == k) & (frame.label == y)].sum() for k in range(3) for y in (0, 1)]
    assert each == [32_000, 8_000] * 3
    assert B._Booster(frame, 0, {}, 3).rows == 80_000
    nodes = B.fit_folds(spark, frame, B.sample_space(1, 3)[0], folds=3, rounds=1)
    assert [r.rows for r in nodes.where("round = 0").collect()] == [80_000] * 3


def test_counted_entries_give_the_models_of_the_rows(spark, data, monkeypatch):
    features = ["a", "b", "c"]
    rows = B.binned_frame(data, features, folds=3, bins=4)
    monkeypatch.setattr(B, "CELLS_ABOVE", 100)
    counted = B.binned_frame(data, features, folds=3, bins=4)
    assert rows.count is None and counted.count.sum() == 420 and len(counted.bins) < 200
    assert [e.tolist() for e in rows.edges] == [e.tolist() for e in counted.edges]
    many = lambda f, n: sorted(zip(f.bins.tolist(), f.label, f.fold, strict=True)) if n is None else sorted(
        x for x, k in zip(zip(f.bins.tolist(), f.label, f.fold, strict=True), n.tolist(), strict=True) for _ in range(k))
    assert many(rows, None) == many(counted, counted.count)
    # Rows as cells (they are more than CELLS_ABOVE now) and entries are the same sums.
    params = {"num_leaves": 7, "learning_rate": 0.1, "feature_fraction": 0.7, "max_depth": 4}
    whole = B.BinnedFrame(features, rows.edges, rows.bins, rows.label, rows.fold)
    for fold in range(3):
        one, other = B._Booster(whole, fold, params, 3), B._Booster(counted, fold, params, 3)
        assert [one.step() for _ in range(8)] == [other.step() for _ in range(8)] and one.held_out_auc() == other.held_out_auc()
    assert B.cross_validate(whole, params, 3, 20, 5, 1).tolist() == B.cross_validate(counted, params, 3, 20, 5, 1).tolist()


def test_search_uses_rows_behind_the_first_hundred_thousand(spark):
    """Only in rows behind the first 100,000 of the seeded order does ``a`` tell the label."""
    place = F.row_number().over(Window.orderBy(B.seeded_order_key("id", 43), "id"))
    df = spark.range(130_000).withColumn("at", place).selectExpr("id", "double(id % 2) a", "int(if(at <= 100000, id % 3 = 0, id % 2 = 0)) label")
    got = B.search(spark, B.binned_frame(df, ["a"], folds=3), [B.sample_space(1, 3)[0]], folds=3, rounds=2, patience=1).first()
    assert got.score > 0.55


def _repeated(n):
    """Rows of 24 cells at most, with a missing value among them."""
    r = np.random.default_rng(4)
    a, b, c = r.integers(0, 4, n), r.integers(0, 3, n), r.integers(0, 2, n)
    y = (r.random(n) < 0.15 + 0.1 * a + 0.2 * (b == 1) * c).astype(float)
    return B.BinnedFrame(list("abc"), [np.arange(3.0), np.arange(2.0), np.arange(1.0)], np.stack([a, b, c], 1).astype(np.uint8), y, np.arange(n) % 3)


def test_rounds_work_on_cells_and_give_the_trees_of_all_rows(monkeypatch):
    f, sizes, grow = _repeated(B.CELLS_ABOVE + 2000), [], B.grow
    monkeypatch.setattr(B, "grow", lambda bins, *more: sizes.append(len(bins)) or grow(bins, *more))
    params = {"num_leaves": 7, "learning_rate": 0.1, "feature_fraction": 1.0, "max_depth": 4}
    for fold in range(3):
        model, train, held = B._Booster(f, fold, params, 3), f.fold != fold, f.fold == fold
        score = np.full(len(f.label), model.start)
        for _ in range(12):
            p = 1 / (1 + np.exp(-score[train]))
            want = grow(f.bins[train], p - f.label[train], p * (1 - p), np.arange(3), 7, 4)
            got = model.step()
            assert [(*n[:4], n[6]) for n in got] == [(*n[:4], n[6]) for n in want] and len(got) > 5
            assert [n[4:6] for n in got] == [pytest.approx((0.1 * n[4], n[5]), rel=1e-6, abs=1e-9) for n in want]
            score += 0.1 * B.tree_values(want, f.bins)
            assert model.held_out_auc() == pytest.approx(B.auc(f.label[held], np.round(score[held], 9)))
    assert max(sizes) <= 24
    small = _repeated(B.CELLS_ABOVE)
    assert small.cells[0] is small.bins and small.cells[1].tolist() == list(range(B.CELLS_ABOVE))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=12))
def test_auc_of_counts_equals_that_of_the_rows(groups):
    y = np.concatenate([np.repeat([1.0, 0.0], [p, q]) for p, q, _ in groups])
    s = np.concatenate([np.full(p + q, float(k)) for p, q, k in groups])
    p, q, k = (np.array(v, float) for v in zip(*groups, strict=True))
    assert B.auc(p, k, p + q) == pytest.approx(B.auc(y, s) if len(y) else 0.5)


def test_prediction_of_repeated_cells_equals_that_of_every_row(spark):
    f = _repeated(600)
    names = f.features
    df = spark.createDataFrame([(i, *map(float, x), int(y)) for i, (x, y) in enumerate(zip(f.bins - 0.5, f.label, strict=True))],
                               "id long, a double, b double, c double, label int")
    nodes = B.fit_folds(spark, f, {"num_leaves": 5, "learning_rate": 0.2, "feature_fraction": 0.7, "max_depth": 3}, folds=3, rounds=4).collect()
    got = {r.id: r.p for r in B.predict_folds(df, spark.createDataFrame(nodes, B._NODES), f, "id").collect()}
    bins = np.stack([B.bin_values(f.bins[:, k] - 0.5, f.edges[k]) for k in range(len(names))], 1)
    total = 0.0
    for fold in range(3):
        trees = [[(n.feature, n.bin, n.left, n.right, n.value) for n in sorted(nodes, key=lambda n: n.node) if (n.fold, n.round) == (fold, r)] for r in range(5)]
        total = total + 1 / (1 + np.exp(-sum(B.tree_values(t, bins) for t in trees))) / 3
    assert len(got) == 600 and [got[i] for i in range(600)] == pytest.approx(list(total))


def test_importances_of_a_hand_made_tree(spark):
    rows = [(0, 0, 0, -1, 0, -1, -1, 0.1, 0.0, 9), (0, 1, 0, 1, 3, 1, 2, 0.0, 4.0, 9), (0, 1, 1, -1, 0, -1, -1, 0.5, 0.0, 5),
            (0, 1, 2, 0, 1, 3, 4, 0.0, 2.0, 4), (0, 1, 3, -1, 0, -1, -1, 0.5, 0.0, 2), (0, 1, 4, -1, 0, -1, -1, 0.5, 0.0, 2),
            (1, 1, 0, 1, 2, 1, 2, 0.0, 1.0, 9), (1, 1, 1, -1, 0, -1, -1, 0.5, 0.0, 5), (1, 1, 2, -1, 0, -1, -1, 0.5, 0.0, 4)]
    got = B.importances(spark.createDataFrame(rows, B._NODES), ["x", "y", "z"], folds=2).collect()
    assert {r.feature: (r.splits, r.gain) for r in got} == {"x": (0.5, 1.0), "y": (1.0, 2.5), "z": (0.0, 0.0)}
