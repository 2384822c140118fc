"""Relational naive Bayes, splits and evaluation: invariants and a numpy cross-check."""
import math

import numpy as np
from pyspark.sql import functions as F

from corpusflow.operators import models as md
from corpusflow.plans import queries


def _toy(spark):
    # doc, class, features (sparse)
    rows = [(1, 0, {"a": 2.0, "b": 1.0}), (2, 0, {"a": 1.0}), (3, 1, {"c": 3.0}), (4, 1, {"b": 1.0, "c": 1.0}),
            (5, 2, {"d": 1.0}), (6, 2, {})]
    matrix = spark.createDataFrame([(d, f, v) for d, _, fs in rows for f, v in fs.items()],
                                   "doc_id long, feature string, value double")
    labels = spark.createDataFrame([(d, c) for d, c, _ in rows], "doc_id long, class_id int")
    return rows, matrix, labels


def test_nb_matches_dense_numpy(spark):
    rows, matrix, labels = _toy(spark)
    feats = ["a", "b", "c", "d"]
    X = np.array([[fs.get(f, 0.0) for f in feats] for _, _, fs in rows])
    y = np.array([c for _, c, _ in rows])
    alpha = 0.5
    model = md.nb_fit(matrix, labels, alpha=alpha, n_features=F.lit(4))
    scores = {r.doc_id: r.scores for r in md.nb_scores(model, matrix, labels).collect()}
    for i, (d, _, _) in enumerate(rows):
        for c in range(3):
            fc = X[y == c].sum(axis=0)
            theta = np.log((fc + alpha) / (fc.sum() + alpha * 4))
            prior = math.log((y == c).mean())
            assert abs(scores[d][c] - (prior + X[i] @ theta)) < 1e-9


def test_nb_posteriors(spark):
    _, matrix, labels = _toy(spark)
    model = md.nb_fit(matrix, labels)
    pred = md.nb_predict(model, matrix, labels).collect()
    assert len(pred) == 6   # the document without features still gets a prediction
    for r in pred:
        assert 0.0 <= r.confidence <= 1.0
        assert len(r.top) <= 5
        assert abs(sum(t.confidence for t in r.top) - 1.0) < 1e-9   # 3 classes: top holds all


def test_folds_partition_rows(spark):
    labels = spark.createDataFrame([(i, i % 3) for i in range(300)], "doc_id long, class_id int")
    folds = md.kfold_assign(labels, 5)
    assert folds.count() == 300
    per = folds.groupBy("class_id", "fold").count().collect()
    assert {r["count"] for r in per} == {20}


def test_holdout_is_stratified(spark):
    labels = spark.createDataFrame([(i, 0 if i < 90 else 1) for i in range(100)], "doc_id long, class_id int")
    split = md.split_holdout(labels, 0.2)
    got = {(r.class_id, r.is_test): r["count"] for r in split.groupBy("class_id", "is_test").count().collect()}
    assert got[(0, True)] == 18 and got[(1, True)] == 2


def test_classification_report_zero_division(spark):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "class_id int, pred_class_id int")
    rep = {r["class"]: r for r in md.classification_report(pred).collect()}
    assert rep["2"].precision == 0.0 and rep["2"].recall == 0.0
    assert rep["accuracy"].precision == 0.5


def test_nb_grid_matches_dense_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 60)
    X = rng.poisson(0.6 + 2.0 * (np.arange(12)[None, :] % 3 == y[:, None]), (60, 12)).astype(float)
    X[:, 10], X[:, 11] = 5.0 + X[:, 10], 2.0  # in every row; constant
    matrix = spark.createDataFrame([(i, f"f{j:02d}", float(X[i, j])) for i in range(60) for j in range(12) if X[i, j]],
                                   "doc_id long, feature string, value double")
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(y)], "doc_id long, class_id int")
    fold = np.array([r.fold for r in md.kfold_assign(labels, 3).orderBy("doc_id").collect()])
    ks, alphas = [2, 5, 9], [0.01, 1.0, 10.0]
    got = {(r.selector, r.k, r.alpha, r.fit_prior): (r.cv_accuracy, r.cv_std) for r in md.nb_grid_cv(matrix, labels, ks, alphas).collect()}
    assert len(got) == 2 * 3 * 3 * 2
    for (selector, k, alpha, prior), found in got.items():
        acc = []
        for j in range(3):
            A, b, H = X[fold != j], y[fold != j], X[fold == j]
            n_c = np.bincount(b, minlength=3)
            s1 = np.array([A[b == c].sum(0) for c in range(3)])
            q = (s1 ** 2 / n_c[:, None]).sum(0)
            total = s1.sum(0)
            with np.errstate(divide="ignore", invalid="ignore"):
                f = (q - total ** 2 / len(b)) / 2 / (((A ** 2).sum(0) - q) / (len(b) - 3))
            f[11] = -1.0
            rank = f if selector == "f_score" else q * len(b) / total - total
            top = np.argsort(-np.round(rank, 9), kind="stable")[:k]
            low, span = A[:, top].min(0), np.ptp(A[:, top], 0)
            span[span == 0] = 1
            A, H = (A[:, top] - low) / span, (H[:, top] - low) / span
            counts = np.array([A[b == c].sum(0) for c in range(3)]) + alpha
            joint = H @ np.log(counts / counts.sum(1, keepdims=True)).T + (np.log(n_c / len(b)) if prior else 0)
            acc.append((np.round(joint, 9).argmax(1) == y[fold == j]).mean())
        assert found == (round(float(np.mean(acc)), 6), round(float(np.std(acc)), 6)), (selector, k, alpha, prior)


def test_grids_are_the_references():
    assert len(set(queries.LR_CELLS)) == 26 and sum(l1 == 1.0 for _, l1 in queries.LR_CELLS) == 5 and len(queries.SUBSETS) == 9
