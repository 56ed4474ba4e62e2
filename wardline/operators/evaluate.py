"""Model evaluation as Spark jobs: threshold metrics, exact ROC / PR curves
(ties handled per distinct score), their areas, CV bands, ensembles.

Every curve starts from one aggregate: positives and negatives per distinct
score.  Heavy ties collapse there, and the cumulative counts along the
descending score order come from the distributed running sum
(``global_cumsum``) instead of a single-partition window.  Areas are sums
over that table; no point list ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.indexing import global_cumsum, global_index
from wardline.session import materialize


def score_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per distinct score: tp (positives), fp (negatives), and cumulative
    ``cum_tp``, ``cum_fp``, ``cum_one`` (1-based position) in descending
    score order.  The table is written once (``materialize``): totals, points and areas
    all read it, and the input is scanned once."""
    g = df.where(F.col(p).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(p).cast("double").alias("score")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("tp"),
        F.sum((F.col(y) != 1).cast("long")).alias("fp"),
        F.lit(1).cast("long").alias("one"))
    return materialize(global_cumsum(materialize(g), ["score"], ["tp", "fp", "one"], ascending=False))


def _totals(counts: DataFrame):
    """Positive and negative totals as literals (one bounded one-row result).

    Literals rather than scalar subqueries: an aggregate may not take a
    subquery over a non-deterministic plan (e.g. model predictions)."""
    r = counts.agg(F.sum("tp").cast("double").alias("p"), F.sum("fp").cast("double").alias("n")).first()
    return F.lit(r["p"]), F.lit(r["n"])


def threshold_metrics(df: DataFrame, y: str, p: str, cut: float = 0.5) -> DataFrame:
    """accuracy, precision, recall, f1 of ``p > cut`` (undefined ratios -> 0)."""
    pred = F.col(p) > F.lit(cut)
    pos = F.col(y) == 1
    a = df.agg(F.sum((pred & pos).cast("long")).alias("tp"),
               F.sum((pred & ~pos).cast("long")).alias("fp"),
               F.sum((~pred & pos).cast("long")).alias("fn"),
               F.sum((~pred & ~pos).cast("long")).alias("tn"))

    def ratio(n, d):
        return F.when(d == 0, F.lit(0.0)).otherwise(n.cast("double") / d)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return a.select(ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                    ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"))


def roc_curve(df: DataFrame, y: str, p: str, *, drop_intermediate: bool = True) -> DataFrame:
    """ROC points (threshold, fpr, tpr): the origin (threshold +inf) and one point
    per distinct score; with ``drop_intermediate`` a point whose step equals
    the next point's step (collinear) is dropped, as the usual routine does."""
    c = score_counts(df, y, p)
    npos, nneg = _totals(c)
    pts = c.withColumn("idx", F.col("cum_one") - F.lit(1))
    if drop_intermediate:
        nxt = pts.select((F.col("idx") - F.lit(1)).alias("idx"), F.col("tp").alias("_ntp"),
                         F.col("fp").alias("_nfp"))
        pts = pts.join(nxt, "idx", "left").where(
            (F.col("idx") == 0) | F.col("_ntp").isNull()
            | (F.col("_ntp") != F.col("tp")) | (F.col("_nfp") != F.col("fp")))
    body = pts.select(F.col("score").alias("threshold"),
                      (F.col("cum_fp") / nneg).alias("fpr"), (F.col("cum_tp") / npos).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(body)


def roc_auc(df: DataFrame, y: str, p: str, counts: DataFrame | None = None) -> DataFrame:
    """Exact area under the ROC curve (tied scores count one half)."""
    c = score_counts(df, y, p) if counts is None else counts
    npos, nneg = _totals(c)
    tpr = F.col("cum_tp") / npos
    tpr_prev = (F.col("cum_tp") - F.col("tp")) / npos
    area = F.sum(F.col("fp") / nneg * (tpr + tpr_prev) / F.lit(2.0))
    return c.agg(area.alias("roc_auc"))


def _pr_points(c: DataFrame, npos):
    first_full = c.where(F.col("cum_tp") >= npos).agg(F.max("score")).first()[0]
    return c.where(F.col("score") >= F.lit(first_full))


def pr_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """PR points (threshold, recall, precision) from the first threshold that
    reaches full recall up to the highest score, plus the end point
    (recall 0, precision 1, threshold NULL)."""
    c = score_counts(df, y, p)
    npos, _ = _totals(c)
    pts = _pr_points(c, npos)
    body = pts.select(F.col("score").alias("threshold"), (F.col("cum_tp") / npos).alias("recall"),
                      (F.col("cum_tp").cast("double") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    return body.unionByName(end)


def pr_auc(df: DataFrame, y: str, p: str, counts: DataFrame | None = None) -> DataFrame:
    """Trapezoid area under the PR points of ``pr_curve`` (not average precision)."""
    c = score_counts(df, y, p) if counts is None else counts
    npos, _ = _totals(c)
    pts = _pr_points(c, npos)
    prec = F.col("cum_tp").cast("double") / (F.col("cum_tp") + F.col("cum_fp"))
    prev_tp = F.col("cum_tp") - F.col("tp")
    prev_all = prev_tp + F.col("cum_fp") - F.col("fp")
    prec_prev = F.when(prev_all == 0, F.lit(1.0)).otherwise(prev_tp.cast("double") / prev_all)
    area = F.sum(F.col("tp") / npos * (prec + prec_prev) / F.lit(2.0))
    return pts.agg(area.alias("pr_auc"))


def classification_metrics(df: DataFrame, y: str, p: str, cut: float = 0.5) -> DataFrame:
    """One row: accuracy, roc_auc, pr_auc, precision, recall, f1."""
    m = threshold_metrics(df, y, p, cut)
    counts = score_counts(df, y, p)          # one per-score table for both areas
    total = counts.agg(F.sum("tp").alias("p"), F.sum("fp").alias("n")).first()
    auc = roc_auc(df, y, p, counts).select("roc_auc").scalar()
    if not total["p"] or not total["n"]:
        raise ValueError("classification metrics need scored rows of both classes")
    prc = pr_auc(df, y, p, counts).select("pr_auc").scalar()
    return m.select("accuracy", auc.alias("roc_auc"), prc.alias("pr_auc"), "precision", "recall", "f1")


def curve_auc(df: DataFrame, order: str, x: str, y: str) -> DataFrame:
    """Trapezoid area of a stored curve whose points are sequenced by ``order``."""
    idx = global_index(df.select(order, x, y), [order], name="_i")
    nxt = idx.select((F.col("_i") - F.lit(1)).alias("_i"), F.col(x).alias("_nx"), F.col(y).alias("_ny"))
    seg = idx.join(nxt, "_i")
    area = F.sum((F.col("_nx") - F.col(x)) * (F.col(y) + F.col("_ny")) / F.lit(2.0))
    return seg.agg(F.abs(area).alias("auc"))


def cv_band(df: DataFrame, by: str, value: str, z: float = 1.96) -> DataFrame:
    """Per ``by`` (boosting round, fold, ...): mean, population sd and the
    mean -/+ z*sd band."""
    g = df.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    return g.withColumns({"lower": F.col("mean") - F.lit(z) * F.col("sd"),
                          "upper": F.col("mean") + F.lit(z) * F.col("sd")})


def ensemble_mean(df: DataFrame, key: str, p: str, name: str = "p_mean") -> DataFrame:
    """Average prediction per key over models / folds."""
    return df.groupBy(key).agg(F.avg(p).alias(name))


def weighted_mean(df: DataFrame, value: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """``sum(value * weight) / sum(weight)`` (running batch-loss average)."""
    return df.groupBy(*by).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("weighted_mean"))


def top_k(df: DataFrame, col: str, k: int = 10, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest ``col`` (a top-k report: the limit is the
    feature); ties broken by ``tiebreak`` ascending.  Planned as
    TakeOrderedAndProject: each task keeps k rows, the driver merges k per task."""
    return df.orderBy(F.col(col).desc(), *[F.col(c).asc() for c in tiebreak]).limit(k)
