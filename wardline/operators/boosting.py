"""Boosted trees: parameter search, staged held-out AUC, fold ensembles, importances.

A fit works on a *binned frame*: quantile edges of every feature and the bin numbers of all
rows.  Trials are rows of a DataFrame, one task each; the binned frame is broadcast.  Rows whose bins
agree in every feature are one cell: they stay together in every tree, so trees grow on the cells with
their numbers of rows and positives, and a round costs as much as there are cells.  The executors bin and
count: the driver gets one entry for every cell, label and fold, however many rows there are (few where
features have few bins together; as many as rows where they are many and wide).  Small frames (``CELLS_ABOVE``)
come and add up row by row, as sums by cell may round otherwise and so decide between equal gains.  Within a trial the folds
grow their trees round by round together, the mean held-out AUC of every round decides when
to stop, and each tree adds its leaf values to one running score per row, so that the AUC
of every round comes from a single pass.  Scores, importances and curves are
DataFrame work again: the trees are a table of nodes, and all rows are scored where they lie.

Trees grow leaf by leaf (largest gain first) up to ``num_leaves`` leaves and ``max_depth``
levels on histograms of gradients; a missing value has the lowest bin of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.features import stratified_folds
from wardline.operators.matching import seeded_order_key
from wardline.session import ship_package

MIN_ROWS = 20          # in a leaf
MIN_HESSIAN = 1e-3
CELLS_ABOVE = 10_000   # rows; up to these, every row is a cell of its own
#: Search space: (lowest, highest, step); no step means a uniform draw.
SPACE = {"num_leaves": (2, 21, 1), "learning_rate": (0.005, 0.2, None), "feature_fraction": (0.1, 1.0, None), "max_depth": (2, 11, 1)}


@dataclass
class BinnedFrame:
    """Bins of the rows to fit on, their labels and folds, and the edges that define the bins.

    With ``count``, entry i stands for count[i] rows with these bins, this label and this fold."""

    features: list[str]
    edges: list[np.ndarray]
    bins: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    count: np.ndarray | None = None

    @cached_property
    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct rows of ``bins``, and the cell of every entry."""
        if self.count is None and len(self.bins) <= CELLS_ABOVE:
            return self.bins, np.arange(len(self.bins))
        return distinct_rows(self.bins)


def distinct_rows(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the place of every row among them."""
    if not bins.size:
        return bins[:1], np.zeros(len(bins), np.int64)
    cells, at = np.unique(bins, axis=0, return_inverse=True)
    return cells, at.reshape(-1)


def bin_values(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """0 for a missing value, else 1 + the number of edges below the value."""
    return np.where(np.isnan(x), 0, 1 + np.searchsorted(edges, x)).astype(np.uint8)


def binned_frame(df: DataFrame, features: Sequence[str], label: str = "label", *, id_col: str = "id", folds: int = 5, seed: int = 42,
                 bins: int = 64, max_rows: int | None = None) -> BinnedFrame:
    """Bin a training frame, all of its rows unless the caller wants ``max_rows`` at most (those with the smallest
    seeded hash).  The driver gets ``bins`` edges a feature and, above ``CELLS_ABOVE`` rows, an entry a cell, label and fold."""
    if not 2 <= bins <= 250:
        raise ValueError("bins must be 2 to 250")
    features = list(features)
    values = [F.col(c).cast("double").alias(c) for c in features]
    data = stratified_folds(df, id_col, label, folds, seed=seed).select(id_col, F.col(label).cast("int").alias("_y"), "fold", *values)
    edges = [np.unique([v for v in q if np.isfinite(v)]) for q in data.approxQuantile(features, [k / bins for k in range(1, bins)], 0.001)]
    if max_rows is None and df.count() > CELLS_ABOVE:
        return _counted_frame(data.drop(id_col), features, edges)
    rows = data.orderBy(seeded_order_key(id_col, seed + 1), id_col)
    rows = (rows if max_rows is None else rows.limit(max_rows)).drop(id_col).toArrow()
    x = [rows.column(c).to_numpy().astype(float) for c in features]
    binned = np.stack([bin_values(v, e) for v, e in zip(x, edges, strict=True)], 1) if features else np.zeros((rows.num_rows, 0), np.uint8)
    return BinnedFrame(features, edges, binned, rows.column("_y").to_numpy().astype(float), rows.column("fold").to_numpy())


def _counted_frame(data: DataFrame, features: list[str], edges: list[np.ndarray]) -> BinnedFrame:
    """The entries of all rows of ``data`` (_y, fold and the features), binned and counted where they lie: a cell
    is its bins as bytes."""
    ship_package(data.sparkSession)
    data = data.select("_y", "fold", *[F.col(c).alias(f"_x{k}") for k, c in enumerate(features)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [b.column(k + 2).to_numpy(zero_copy_only=False).astype(float) for k in range(len(edges))]
            binned = np.stack([bin_values(v, e) for v, e in zip(x, edges, strict=True)], 1) if edges else np.zeros((b.num_rows, 0), np.uint8)
            cells, at = distinct_rows(binned)
            names = pa.array([c.tobytes() for c in cells], pa.binary()).take(pa.array(at))
            part = pa.table([b.column(0), b.column(1), names], ["_y", "fold", "cell"]).group_by(["_y", "fold", "cell"], use_threads=False).aggregate([([], "count_all")])
            yield from part.select(["_y", "fold", "cell", "count_all"]).rename_columns(["_y", "fold", "cell", "n"]).combine_chunks().to_batches()

    counted = data.mapInArrow(run, "_y int, fold int, cell binary, n long").groupBy("cell", "fold", "_y").agg(F.sum("n").alias("n"))
    rows = counted.orderBy("cell", "fold", "_y").toArrow()
    binned = np.frombuffer(b"".join(rows.column("cell").to_pylist()), np.uint8).reshape(rows.num_rows, len(features))
    return BinnedFrame(features, edges, binned, rows.column("_y").to_numpy().astype(float), rows.column("fold").to_numpy(), rows.column("n").to_numpy())


def sample_space(trials: int, seed: int, space: Mapping[str, tuple] = SPACE) -> list[dict]:
    """Seeded draws: uniform, or uniform and rounded to the step."""
    rng = np.random.default_rng(seed)
    out = []
    for t in range(trials):
        draw = {"trial": t}
        for name, (low, high, step) in space.items():
            v = rng.uniform(low, high)
            draw[name] = float(v) if step is None else int(np.clip(np.round(v / step) * step, low, high))
        out.append(draw)
    return out


def auc(y: np.ndarray, score: np.ndarray, count: np.ndarray | None = None) -> float:
    """Area under the ROC curve, ties counting half; 0.5 where a class is absent.  With ``count``, entry i
    stands for count[i] rows of the same score, y[i] of them positive."""
    _, at = np.unique(score, return_inverse=True)
    n = np.bincount(at, count)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    pos = y.sum()
    neg = n.sum() - pos
    return 0.5 if not pos or not neg else float(((rank * y).sum() - pos * (pos + 1) / 2) / (pos * neg))


def grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, features: np.ndarray, num_leaves: int, max_depth: int,
         count: np.ndarray | None = None) -> list[tuple]:
    """Nodes (feature, bin, left, right, value, gain, rows) of one tree; a leaf has feature -1.

    A row goes left if its bin is at most the node's.  With ``count``, entry i stands for count[i] rows,
    whose gradients and Hessians ``grad`` and ``hess`` add up."""
    if count is None:
        count = np.ones(len(bins))
    width = int(bins.max(initial=0)) + 1
    place = bins[:, features].astype(np.int64) + np.arange(len(features)) * width

    def histogram(rows):
        flat = place[rows].reshape(-1)
        repeat = len(features)
        return np.stack([np.bincount(flat, w, repeat * width).reshape(repeat, width) for w in
                         (np.repeat(grad[rows], repeat), np.repeat(hess[rows], repeat), np.repeat(count[rows], repeat))])

    def best(h):
        left = h.cumsum(2)[:, :, :-1]
        total = h[:, :1].sum(2, keepdims=True)
        right = total - left
        ok = (left[2] >= MIN_ROWS) & (right[2] >= MIN_ROWS) & (left[1] >= MIN_HESSIAN) & (right[1] >= MIN_HESSIAN)
        if not ok.any():
            return 0.0, 0, 0
        g, c = total[0, 0, 0], total[1, 0, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - g * g / c, 0.0)
        k = int(gain.argmax())
        return float(gain.reshape(-1)[k]), k // gain.shape[1], k % gain.shape[1]

    def may_split(rows, depth):
        return depth < max_depth and count[rows].sum() >= 2 * MIN_ROWS

    def leaf(rows, depth, h):
        nodes.append([-1, 0, -1, -1, -grad[rows].sum() / max(hess[rows].sum(), MIN_HESSIAN), 0.0, int(count[rows].sum())])
        if may_split(rows, depth):
            open_.append((*best(h), len(nodes) - 1, rows, depth, h))
        return len(nodes) - 1

    nodes: list[list] = []
    open_: list[tuple] = []
    every = np.arange(len(bins))
    leaf(every, 0, histogram(every) if may_split(every, 0) else None)
    for _ in range(num_leaves - 1):
        if not open_:
            break
        k = max(range(len(open_)), key=lambda i: open_[i][0])
        gain, f, cut, at, rows, depth, h = open_[k]
        if gain <= 1e-12:
            break
        open_.pop(k)
        go = bins[rows, features[f]] <= cut
        left, right = rows[go], rows[~go]
        hl = hr = None
        if may_split(left, depth + 1) or may_split(right, depth + 1):
            small = histogram(left if len(left) <= len(right) else right)
            hl, hr = (small, h - small) if len(left) <= len(right) else (h - small, small)
        nodes[at][:4] = [int(features[f]), cut, leaf(left, depth + 1, hl), leaf(right, depth + 1, hr)]
        nodes[at][5] = gain
    return [tuple(x) for x in nodes]


def tree_values(nodes: Sequence[tuple], bins: np.ndarray) -> np.ndarray:
    """Leaf value of every row."""
    feature, cut, left, right, value = (np.array([n[k] for n in nodes]) for k in range(5))
    at = np.zeros(len(bins), np.int64)
    while (inner := np.flatnonzero(feature[at] >= 0)).size:
        here = at[inner]
        at[inner] = np.where(bins[inner, feature[here]] <= cut[here], left[here], right[here])
    return value[at]


class _Booster:
    """One fold's model while it grows."""

    def __init__(self, frame: BinnedFrame, fold: int, params: Mapping, seed: int):
        self.fold, self.params, self.seed, self.round = fold, params, seed, 0
        self.bins, at = frame.cells

        def per_cell(rows):
            n = np.ones(int(rows.sum())) if frame.count is None else frame.count[rows]
            return np.bincount(at[rows], n, len(self.bins)), np.bincount(at[rows], n * frame.label[rows], len(self.bins))

        count, positive = per_cell(frame.fold != fold)
        self.rows = int(count.sum())
        self.train = np.flatnonzero(count)
        self.count, self.positive = count[self.train], positive[self.train]
        count, positive_held = per_cell(frame.fold == fold)
        self.held = np.flatnonzero(count)
        self.held_count, self.held_positive = count[self.held], positive_held[self.held]
        share = np.clip(positive.sum() / self.rows if self.rows else 0.5, 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        self.score = np.full(len(self.bins), self.start)

    def step(self) -> list[tuple]:
        """Grow the next tree and add it to the scores."""
        p = 1 / (1 + np.exp(-self.score[self.train]))
        k = self.bins.shape[1]
        rng = np.random.default_rng([self.seed, self.fold, self.round])
        chosen = np.sort(rng.permutation(k)[:max(1, round(k * self.params["feature_fraction"]))])
        nodes = grow(self.bins[self.train], self.count * p - self.positive, self.count * p * (1 - p), chosen,
                     self.params["num_leaves"], self.params["max_depth"], self.count)
        rate = self.params["learning_rate"]
        nodes = [(*n[:4], rate * n[4], *n[5:]) for n in nodes]
        self.score += tree_values(nodes, self.bins)
        self.round += 1
        return nodes

    def held_out_auc(self) -> float:
        return auc(self.held_positive, self.score[self.held], self.held_count)


def cross_validate(frame: BinnedFrame, params: Mapping, folds: int, rounds: int, patience: int, seed: int) -> np.ndarray:
    """Held-out AUC [round, fold] up to the best round: growing stops when the mean over the
    folds has not risen for ``patience`` rounds."""
    models = [_Booster(frame, k, params, seed) for k in range(folds)]
    out, best, at = [], -1.0, 0
    for r in range(rounds):
        for m in models:
            m.step()
        out.append([m.held_out_auc() for m in models])
        mean = float(np.mean(out[-1]))
        if mean > best:
            best, at = mean, r
        elif r - at >= patience:
            break
    return np.array(out[:at + 1])


_TRIAL = "trial int, num_leaves int, learning_rate double, feature_fraction double, max_depth int"


def _each(spark, rows: Sequence[dict], schema: str, run, out: str) -> DataFrame:
    """One task for each row."""
    ship_package(spark)
    numbered = spark.createDataFrame([(*r.values(), k) for k, r in enumerate(rows)], f"{schema}, _task int")
    return numbered.repartitionById(max(1, len(rows)), F.col("_task")).drop("_task").mapInArrow(run, out)


def search(spark, frame: BinnedFrame, trials: Sequence[dict], *, folds: int = 5, rounds: int = 1000, patience: int = 100,
           seed: int = 42) -> DataFrame:
    """One row per trial: its parameters, ``rounds`` (the best one), ``score`` (the mean held-out AUC over
    all rounds up to it, rounded to 5 digits) and ``aucs`` ([round][fold])."""
    shared = spark.sparkContext.broadcast(frame)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.to_pylist():
                got = cross_validate(shared.value, t, folds, rounds, patience, seed)
                more = {"rounds": len(got), "score": round(float(got.mean(1).mean()), 5) if len(got) else None, "aucs": got.tolist()}
                yield pa.RecordBatch.from_pylist([t | more], schema=pa.schema([
                    ("trial", pa.int32()), ("num_leaves", pa.int32()), ("learning_rate", pa.float64()), ("feature_fraction", pa.float64()),
                    ("max_depth", pa.int32()), ("rounds", pa.int32()), ("score", pa.float64()), ("aucs", pa.list_(pa.list_(pa.float64())))]))

    return _each(spark, trials, _TRIAL, run, f"{_TRIAL}, rounds int, score double, aucs array<array<double>>")


def best_trial(results: DataFrame) -> dict:
    """The trial with the highest score (the first of equals)."""
    row = results.orderBy(F.col("score").desc_nulls_last(), "trial").first()
    if row is None:
        raise ValueError("no trial")
    return row.asDict()


_NODES = "fold int, round int, node int, feature int, bin int, left int, right int, value double, gain double, rows long"


def fit_folds(spark, frame: BinnedFrame, params: Mapping, *, folds: int = 5, rounds: int, seed: int = 42) -> DataFrame:
    """Trees of one model per fold as a table of nodes, a task per fold.  Round 0 holds the start score."""
    shared = spark.sparkContext.broadcast(frame)
    kinds = [pa.int32()] * 7 + [pa.float64()] * 2 + [pa.int64()]
    names = [x.split()[0] for x in _NODES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fold in b.column("fold").to_pylist():
                model = _Booster(shared.value, fold, params, seed)
                rows = [(fold, 0, 0, -1, 0, -1, -1, model.start, 0.0, model.rows)]
                for r in range(1, rounds + 1):
                    rows += [(fold, r, k, *n) for k, n in enumerate(model.step())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return _each(spark, [{"fold": k} for k in range(folds)], "fold int", run, _NODES)


def predict_folds(df: DataFrame, nodes: DataFrame, frame: BinnedFrame, id_col: str, name: str = "p") -> DataFrame:
    """Every row of ``df`` with the mean probability over the fold models.

    The node table (folds x rounds x leaves rows at most) is broadcast."""
    trees: dict[int, dict[int, list]] = {}
    for r in nodes.orderBy("fold", "round", "node").collect():
        trees.setdefault(r.fold, {}).setdefault(r.round, []).append((r.feature, r.bin, r.left, r.right, r.value))
    ship_package(df.sparkSession)
    features, edges = frame.features, frame.edges
    shared = df.sparkSession.sparkContext.broadcast((trees, edges))
    cols = [F.col(c).cast("double").alias(f"_x{k}") for k, c in enumerate(features)]
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, edges = shared.value
        for b in batches:
            x = [b.column(k + 1).to_numpy(zero_copy_only=False).astype(float) for k in range(len(edges))]
            cells, at = distinct_rows(np.stack([bin_values(v, e) for v, e in zip(x, edges, strict=True)], 1))
            total = np.zeros(len(cells))
            for model in trees.values():
                total += 1 / (1 + np.exp(-sum(tree_values(t, cells) for t in model.values())))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((total / max(1, len(trees)))[at])], ["_id", name])

    scored = df.select(F.col(id_col).alias("_id"), *cols).mapInArrow(run, f"_id {kind}, {name} double")
    return df.join(scored, df[id_col] == F.col("_id")).drop("_id")


def importances(nodes: DataFrame, features: Sequence[str], folds: int = 5) -> DataFrame:
    """(feature, splits, gain): how often a feature splits a node and what that gains, averaged over
    the fold models; features that no tree uses have zeros."""
    names = nodes.sparkSession.createDataFrame([(k, f) for k, f in enumerate(features)], "_k int, feature string")
    used = nodes.where("feature >= 0").groupBy(F.col("feature").alias("_k")).agg(
        (F.count(F.lit(1)) / F.lit(float(folds))).alias("splits"), (F.sum("gain") / F.lit(float(folds))).alias("gain"))
    return names.join(used, "_k", "left").select("feature", F.coalesce("splits", F.lit(0.0)).alias("splits"),
                                                 F.coalesce("gain", F.lit(0.0)).alias("gain"))


def fold_curve(spark, aucs: Sequence[Sequence[float]]) -> DataFrame:
    """(round, fold, auc), rounds from 1: one number per round and fold."""
    return spark.createDataFrame([(r + 1, k, float(v)) for r, row in enumerate(aucs) for k, v in enumerate(row)], "round int, fold int, auc double")
