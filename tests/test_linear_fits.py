"""Logistic regressions fitted together equal MLlib's, one by one, and share their jobs."""
import numpy as np
import pytest
from corpusflow.operators import linear_fits as lf
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F


def table(spark, classes, n=300, d=8):
    rng = np.random.default_rng(classes)
    x = rng.standard_normal((n, d))
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    y = (x[:, :classes] + 0.7 * rng.standard_normal((n, classes))).argmax(1)
    return spark.createDataFrame([(Vectors.dense(r.tolist()), float(c)) for r, c in zip(x, y)], ["scaled", "label"]).repartition(3).persist()


@pytest.mark.parametrize("classes", [2, 3])
def test_weights_equal_mllib(spark, classes):
    d = table(spark, classes)
    held = lf.written(d, "scaled")
    cells = [(1 / 300, 0.0), (1 / 30, 0.1), (1 / 600, 1.0)]
    weights = lf.logistic_weights(held, cells, 2000, 1e-4)
    share = lf.predicted(held, weights)
    for (reg, l1), w, got in zip(cells, weights, share):
        own = LogisticRegression(maxIter=2000, tol=1e-4, featuresCol="scaled", labelCol="label", standardization=False, regParam=reg, elasticNetParam=l1).fit(d)
        centre = (lambda a: a - a.mean(0)) if classes > 2 and not l1 else (lambda a: a)
        assert np.allclose(centre(own.coefficientMatrix.toArray()), centre(w[:, :-1]), atol=1e-6)
        assert got == pytest.approx(own.transform(d).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])


def test_all_fits_share_a_job_for_each_step(spark, monkeypatch):
    held = lf.written(table(spark, 3), "scaled")
    asked = []
    plain = lf.minimise
    monkeypatch.setattr(lf, "minimise", lambda *a: counted(plain(*a)))

    def counted(fit):
        n, point = 0, next(fit)
        try:
            while True:
                n += 1
                point = fit.send((yield point))
        except StopIteration as end:
            asked.append(n)
            return end.value

    sc = spark.sparkContext
    sc.setJobGroup("fits", "fits")
    lf.logistic_weights(held, [(1 / 300, 0.0), (1 / 300, 0.5), (1 / 30, 1.0)], 2000, 1e-4)
    jobs = len(sc.statusTracker().getJobIdsForGroup("fits"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(asked) == 3 and max(asked) <= jobs < sum(asked)


def test_rows_of_one_class_and_no_rows_to_judge(spark):
    d = table(spark, 3).withColumn("label", F.lit(2.0))
    held = lf.written(d, "scaled")
    weights = lf.logistic_weights(held, [(0.1, 0.0)], 10, 1e-4)
    assert lf.predicted(held, weights) == [1.0] and lf.predicted(held.filter("y < 0"), weights) == [None]
