import random

from wardline.operators import evaluate as V
from wardline.operators import train as M


def test_training_smoke(spark):
    random.seed(2)
    rows = []
    for i in range(120):
        y = i % 3 == 0
        rows.append((i, float(y) * 1.5 + random.random(), random.random(), int(y)))
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    feats = ["a", "b"]
    lr = M.train_lr(df, feats)
    auc = V.roc_auc(M.predict(lr, df), "label", "p").first().roc_auc
    assert auc > 0.9
    pairs = M.train_svm_calibrated(df, feats, id_col="id", folds=3, max_iter=10)
    p = M.predict_svm_calibrated(pairs, df, feats).select("p").collect()
    assert all(0.0 <= r.p <= 1.0 for r in p)
