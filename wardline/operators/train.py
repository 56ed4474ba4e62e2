"""Model training as MLlib jobs: logistic regression and calibrated linear SVM
(boosted trees are in ``boosting``).

Training data stay distributed: MLlib fits with tree/vector aggregates over
the partitions, predictions are ``transform`` jobs.  Folds come from
``features.stratified_folds`` (seeded), so every fit is reproducible.
Loops run over folds and parameter sets (a handful), never over rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.scalar import sigmoid
from wardline.operators.features import stratified_folds


def _per_fold(fit, folds: int, parallelism: int) -> list:
    """Fit the folds concurrently (Spark runs jobs from several threads, as
    ``CrossValidator(parallelism=...)`` does); results in fold order."""
    if parallelism <= 1:
        return [fit(k) for k in range(folds)]
    with ThreadPoolExecutor(max_workers=min(parallelism, folds)) as pool:
        return list(pool.map(fit, range(folds)))


def _assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _linear(model, features: Sequence[str]) -> Column:
    """w . x + b of a fitted linear model, as an expression over the feature columns.

    Scores need no vectors then, and plans no longer hold the fitted model (whose training
    summary holds the session, which cannot be sent to executors once it has observed metrics)."""
    terms = [F.col(f).cast("double") * F.lit(float(w)) for f, w in zip(features, model.coefficients.toArray(), strict=True)]
    return reduce(lambda x, y: x + y, terms, F.lit(float(model.intercept)))


ROWS_A_TASK = 100_000


def _ready(train: DataFrame, label: str, features: Sequence[str], strength: float) -> tuple[DataFrame, float]:
    """The assembled rows in as few partitions as they fill (every iteration of a fit is a job over them),
    and the penalty for ``strength`` times the *sum* of the losses beside ||w||^2 / 2, for a fit that averages them."""
    data = _assemble(features).transform(train.withColumn(label, F.col(label).cast("double")))
    n = data.count()
    return data.coalesce(max(1, -(-n // ROWS_A_TASK))), 1.0 / (strength * max(1, n))


def train_lr(train: DataFrame, features: Sequence[str], label: str = "label", *, strength: float = 1.0,
             max_iter: int = 100):
    """L2-regularised logistic regression on the features as they are.

    ``strength`` is the inverse penalty of the usual scientific-python default (1).
    Returns the fitted pipeline model; ``predict(model, df)`` adds ``p``."""
    data, reg = _ready(train, label, features, strength)
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0, maxIter=max_iter,
                            standardization=False)
    return PipelineModel([_assemble(features), lr.fit(data)])


def predict(model, df: DataFrame, name: str = "p") -> DataFrame:
    assembler, lr = model.stages
    return df.withColumn(name, sigmoid(_linear(lr, assembler.getInputCols())))


def train_svm_calibrated(train: DataFrame, features: Sequence[str], label: str = "label", *,
                         id_col: str = "id", folds: int = 5, seed: int = 42, strength: float = 1.0,
                         max_iter: int = 50, parallelism: int = 2):
    """Linear SVM with sigmoid (Platt) calibration by cross-validation.

    For each fold: fit ``LinearSVC`` on the other folds, fit a 1-D logistic
    regression of the label on the SVM margin of the held-out fold.  The
    prediction is the mean calibrated probability over the folds.
    Returns a list of (svm_model, calibrator) pairs.
    """
    data = stratified_folds(train, id_col, label, folds, seed=seed)
    data, reg = _ready(data, label, features, strength * (folds - 1) / folds)
    data = data.cache()

    def fit_fold(k):
        svm = LinearSVC(featuresCol="features", labelCol=label, regParam=reg, maxIter=max_iter, standardization=False).fit(
            data.where(F.col("fold") != k))
        held = data.where(F.col("fold") == k).select(label, _linear(svm, features).alias("margin"))
        held = VectorAssembler(inputCols=["margin"], outputCol="margins").transform(held)
        return svm, LogisticRegression(featuresCol="margins", labelCol=label, regParam=0.0, maxIter=max_iter).fit(held)

    pairs = _per_fold(fit_fold, folds, parallelism)
    data.unpersist()
    return pairs


def predict_svm_calibrated(pairs, df: DataFrame, features: Sequence[str], name: str = "p") -> DataFrame:
    """Mean calibrated probability over the folds."""
    each = [sigmoid(_linear(svm, features) * F.lit(float(cal.coefficients[0])) + F.lit(float(cal.intercept))) for svm, cal in pairs]
    return df.withColumn(name, reduce(lambda x, y: x + y, each) / F.lit(float(len(each))))
