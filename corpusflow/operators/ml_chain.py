"""Vectoriser -> selector -> scaler -> classifier as one MLlib pipeline.

Every step that learns is a pipeline stage, so cross-validation fits the
vocabulary, the selection and the scaling on a fold's training rows only, and a
fitted chain is one ``PipelineModel`` that can be saved and loaded.

Vectors stay sparse up to the selection: the TF-IDF vector comes from MLlib's
``CountVectorizerModel``, ``ElementwiseProduct`` and ``Normalizer`` (JVM, no
array of all features), the length and category columns are appended by
``VectorAssembler``.  Only the selected columns (at most a few hundred) are
centred, hence dense.

What reaches the driver: the vocabulary (at most ``max_features`` terms) and two
numbers per class and feature for the selection.
"""
from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, MinMaxScaler, Normalizer, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusflow.operators import features as fe
from corpusflow.operators import linear_fits as lf
from corpusflow.session import materialised

#: The dense columns that follow the TF-IDF part of a vector.
DENSE = fe.LENGTH_FEATURES + fe.CATEGORY_FEATURES
MAX_FEATURES = 5000
#: Classes of a one-vs-rest model that are fitted at the same time.
PARALLEL = 4


class TfidfVectorizer(Estimator):
    """``terms`` (array of strings) to the TF-IDF vector ``tfidf``; rows are told apart by ``doc_id``.

    The vocabulary and its weights are those of ``features.vocabulary``; a fitted
    one is three JVM stages, or one with ``counts_only``, which leaves raw counts.
    """

    def __init__(self, max_features: int = MAX_FEATURES, min_df=2, max_df=0.95, counts_only: bool = False):
        super().__init__()
        self.max_features, self.min_df, self.max_df, self.counts_only = max_features, min_df, max_df, counts_only

    def _fit(self, rows: DataFrame) -> PipelineModel:
        if "counts" in rows.columns:
            return self._fit_counted(rows)
        if fe.ids_are_unique(rows):
            n = rows.count()
            stats = fe.vocabulary_stats(rows, {None: n}, self.min_df, self.max_df, self.max_features, _ngram(rows))
            vocab = fe.vocabulary_of(stats, n, self.min_df, self.max_df, self.max_features)
        else:
            counts = (rows.select("doc_id", F.explode_outer("terms").alias("term")).where(F.col("term").isNotNull())
                      .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))
            vocab = fe.vocabulary(counts, rows.count(), self.min_df, self.max_df, self.max_features)
        vocab = vocab.select("term", "idf", "feature_index").orderBy("feature_index").collect()  # at most max_features rows
        if not vocab:
            raise ValueError("no term is in enough documents for a vocabulary")
        if self.counts_only:
            return PipelineModel([CountVectorizerModel.from_vocabulary([r.term for r in vocab], inputCol="terms", outputCol="tfidf")])
        return PipelineModel([
            CountVectorizerModel.from_vocabulary([r.term for r in vocab], inputCol="terms", outputCol="tf"),
            ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in vocab]), inputCol="tf", outputCol="weighted"),
            Normalizer(p=2.0, inputCol="weighted", outputCol="tfidf")])


    def _fit_counted(self, rows: DataFrame) -> PipelineModel:
        """The same vocabulary from the vectors of ``counted``; a term outside it weighs 0 and keeps its position."""
        seen = rows.agg(Summarizer.metrics("sum", "numNonZeros", "count").summary(F.col("counts")).alias("s")).first().s
        n, cf = seen["count"], np.rint(seen["sum"].toArray()) if seen["count"] else np.zeros(0)  # a mean times n: near whole numbers
        df = seen["numNonZeros"].toArray() if n else np.zeros(0)
        low, high = (x if isinstance(x, int) else f(x * n) for x, f in ((self.min_df, np.ceil), (self.max_df, float)))
        kept = np.flatnonzero((df >= low) & (df <= high) & (df > 0))
        kept = kept[np.lexsort((kept, -cf[kept]))][:self.max_features]  # positions are alphabetical
        if not len(kept):
            raise ValueError("no term is in enough documents for a vocabulary")
        weight = np.zeros(len(df))
        weight[kept] = 1.0 if self.counts_only else np.log((1.0 + n) / (1.0 + df[kept])) + 1.0
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(weight), inputCol="counts", outputCol="tfidf" if self.counts_only else "weighted")
        return PipelineModel([weigh] if self.counts_only else [weigh, Normalizer(p=2.0, inputCol="weighted", outputCol="tfidf")])


def with_ngrams(rows: DataFrame, ngram, analyzer: str = "word") -> DataFrame:
    """``rows`` of whole documents with ``terms``, the n-grams of the column ``j``; ``j`` stays where they are counted in blocks of documents."""
    terms = rows.select("doc_id", fe.ngrams_of(ngram, analyzer).alias("terms"), *[c for c in rows.columns if c not in ("doc_id", "j")], F.col("j").alias("__j"))
    if not fe.block_ngram(ngram, analyzer):
        return terms.drop("__j")
    return terms.withColumn("j", F.col("__j").alias("j", metadata={"ngram": list(ngram), "analyzer": analyzer})).drop("__j")


def _ngram(rows: DataFrame) -> tuple | None:
    """The n-grams of the column ``j``, as ``with_ngrams`` notes them; None where rows hold only ``terms``."""
    noted = rows.schema["j"].metadata if "j" in rows.columns else None
    return noted and fe.block_ngram(noted["ngram"], noted["analyzer"])


def counted(rows: DataFrame, max_features: int = MAX_FEATURES, min_df=2, max_df=0.95, **_) -> DataFrame:
    """``rows`` with the sparse vector ``counts`` in place of ``terms``.

    The vector's positions are, in alphabetical order, the terms of the vocabularies
    that any pipeline needs which is fitted on all rows with a ``fold`` or on all but
    one fold; leaving the others out changes none of these.  So the terms are read
    twice for all folds and classifiers, and what a fold's fits cache is small.
    Rows whose ids repeat, or without any such term, come back as they are.
    """
    if not fe.ids_are_unique(rows):
        return rows
    learnt = rows.filter(F.col("fold").isNotNull())
    sizes = {r.fold: r["count"] for r in learnt.groupBy("fold").count().collect()}
    n_docs = {left_out: sum(size for fold, size in sizes.items() if fold != left_out) for left_out in [None, *sizes]}
    stats = fe.vocabulary_stats(learnt, n_docs, min_df, max_df, max_features, _ngram(rows))
    terms: set[str] = set()
    for left_out, n in n_docs.items():
        less = {c: F.lit(0) if left_out is None else F.col(f"{c}_{left_out}") for c in ("df", "cf")}
        part = stats.select("term", *[(F.col(c) - less[c]).alias(c) for c in less]).filter(F.col("df") > 0)
        terms |= {r.term for r in fe.vocabulary_of(part, n, min_df, max_df, max_features).select("term").collect()}  # at most max_features rows
    if not terms:
        return rows
    if _ngram(rows):
        made = fe.blocks(_ngram(rows)).term_vectors(rows, [Row(term=t) for t in sorted(terms)], _ngram(rows), counts_only=True, out="counts")
        return materialised(made, {"counts": VectorUDT()})
    model = CountVectorizerModel.from_vocabulary(sorted(terms), inputCol="terms", outputCol="counts")
    return materialised(model.transform(rows).drop("terms"))


def f_scores(rows: DataFrame, features: str = "features", label: str = "label") -> np.ndarray:
    """ANOVA F of every column of a vector; NaN where all classes are constant.

    One pass: mean, variance and count per class come from MLlib's ``Summarizer``,
    which adds sparse vectors up in every task.
    """
    per_class = rows.groupBy(label).agg(Summarizer.metrics("mean", "variance", "count").summary(F.col(features)).alias("s")).collect()
    n = np.array([r.s["count"] for r in per_class], dtype=float)
    mean = np.array([r.s["mean"].toArray() for r in per_class])
    within = (np.array([r.s["variance"].toArray() for r in per_class]) * (n - 1)[:, None]).sum(0)
    centre = (mean * n[:, None]).sum(0) / n.sum()
    between = ((mean - centre) ** 2 * n[:, None]).sum(0)
    if len(n) < 2 or n.sum() <= len(n):
        return np.full(mean.shape[1], np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(within > 1e-12 * (within + between), (between / (len(n) - 1)) / (within / (n.sum() - len(n))), np.nan)


class FScoreSelector(Estimator):
    """The ``k`` columns of the vector ``features`` with the highest ANOVA F (ties by position), as ``selected``."""

    k = Param(Params._dummy(), "k", "number of columns to keep", TypeConverters.toInt)

    def __init__(self, k: int):
        super().__init__()
        self._set(k=k)

    def _fit(self, rows: DataFrame) -> VectorSlicer:
        score = f_scores(rows)
        order = np.lexsort((np.arange(len(score)), -np.nan_to_num(score, nan=-1.0)))
        best = [int(i) for i in order if not np.isnan(score[i])][:self.getOrDefault(self.k)]
        if not best:
            raise ValueError("no column differs between the classes")
        return VectorSlicer(inputCol="features", outputCol="selected", indices=sorted(best))


class Configured(Estimator):
    """A classifier whose settings depend on its training rows: ``make(rows)`` returns it."""

    def __init__(self, make: Callable[[DataFrame], Estimator]):
        super().__init__()
        self.make = make

    def _fit(self, rows: DataFrame):
        return self.make(rows).fit(rows)


def mean_loss(rows: DataFrame, c: float = 1.0) -> float:
    """MLlib weighs the mean loss, the usual ``C`` the summed one: ``regParam = 1 / (C n)``."""
    return 1.0 / (c * max(1, rows.count()))


def perceptron(rows: DataFrame, features: str) -> MultilayerPerceptronClassifier:
    first, top = rows.select(features).first(), rows.agg(F.max("label")).first()
    layers = [len(first[0]), 100, 50, int(top[0]) + 1]
    return MultilayerPerceptronClassifier(layers=layers, maxIter=100, seed=42, featuresCol=features, labelCol="label")


def classifiers() -> dict[str, tuple[int, Estimator | None, Estimator]]:
    """Name -> (selected columns, scaler, classifier), with the sizes of the reference's comparison."""
    scaler = lambda: StandardScaler(inputCol="selected", outputCol="scaled", withMean=True, withStd=True)
    unit = lambda: MinMaxScaler(inputCol="selected", outputCol="scaled")
    cols = {"featuresCol": "scaled", "labelCol": "label"}
    plain = {"featuresCol": "selected", "labelCol": "label"}
    return {
        "logistic_regression": (200, scaler(), Configured(lambda rows: LogisticRegression(
            regParam=mean_loss(rows), maxIter=1000, tol=1e-4, standardization=False, **cols))),
        "linear_svm": (200, scaler(), Configured(lambda rows: OneVsRest(
            classifier=LinearSVC(regParam=mean_loss(rows), maxIter=100, tol=1e-3, standardization=False), parallelism=PARALLEL, **cols))),
        "random_forest": (500, None, RandomForestClassifier(numTrees=100, maxDepth=10, seed=42, **plain)),
        "gradient_boosting": (200, None, OneVsRest(classifier=GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=42), parallelism=PARALLEL, **plain)),
        "multinomial_nb": (500, unit(), NaiveBayes(smoothing=1.0, modelType="multinomial", **cols)),
        "complement_nb": (500, unit(), NaiveBayes(smoothing=1.0, modelType="complement", **cols)),
        "neural_network": (200, scaler(), Configured(lambda rows: perceptron(rows, "scaled"))),
    }


def vector_stages(max_features: int = MAX_FEATURES, min_df=2, max_df=0.95, counts_only: bool = False, dense: list[str] = DENSE) -> list:
    """Terms and ``dense`` columns to the sparse vector ``features``."""
    return [TfidfVectorizer(max_features, min_df, max_df, counts_only), VectorAssembler(inputCols=["tfidf", *dense], outputCol="features")]


def chain(name: str, k: int | None = None, **vectors) -> Pipeline:
    """The whole pipeline of one classifier of ``classifiers()``; ``k`` overrides its number of selected columns."""
    own, scaler, classifier = classifiers()[name]
    return Pipeline(stages=[*vector_stages(**vectors), FScoreSelector(k or own), *([scaler] if scaler else []), classifier])


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the columns of ``features`` for a fitted pipeline that starts with ``vector_stages``."""
    return [*(f"tfidf_{t}" for t in model.stages[0].stages[0].vocabulary), *DENSE]


def vector_rows(features, folds: int = 3) -> DataFrame:
    """(doc_id, label, fold, terms, dense columns): what the pipelines read, one row per document of ``pipeline.Features``."""
    from corpusflow.operators.models import kfold_assign
    assigned = kfold_assign(features.labels, folds).select("doc_id", F.col("class_id").cast("double").alias("label"), "fold")
    # The tokens move, and are written, as one string; their n-grams, several times as long, are cut by each reader.
    made = materialised(features.joined.join(features.dense, "doc_id").join(assigned, "doc_id"))
    return with_ngrams(made, features._ngram, features._analyzer)


def accuracy() -> Column:
    return F.avg((F.col("label") == F.col("prediction")).cast("double"))


def logistic_cells(train: DataFrame, test: DataFrame, cells: list[tuple[float, float]], k: int = 200) -> dict:
    """Accuracy on ``test`` of logistic regression for each ``(C, L1 share)``; vocabulary, selection and scaling are fit once, on ``train``, and all cells together."""
    front = Pipeline(stages=[*vector_stages(), FScoreSelector(k), StandardScaler(inputCol="selected", outputCol="scaled", withMean=True, withStd=True)])
    front = front.fit(train)
    train, test = (lf.written(front.transform(d), "scaled") for d in (train, test))
    n = max(1, train.count())
    weights = lf.logistic_weights(train, [(1.0 / (c * n), l1) for c, l1 in cells], 2000, 1e-4)
    return dict(zip(cells, lf.predicted(test, weights)))


def cross_validate(rows: DataFrame, pipeline: Pipeline, folds: int = 3) -> CrossValidatorModel:
    """Fit on all folds but one, for each in turn, then on all rows; the folds are the column ``fold``."""
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    return CrossValidator(estimator=pipeline, estimatorParamMaps=[{}], evaluator=judge, numFolds=folds, foldCol="fold").fit(rows)


RESULT = "name string, mean_accuracy double, std_accuracy double, n_features int, n_docs long, time_seconds double, status string, error string"


def compare(rows: DataFrame, names: list[str], folds: int = 3, **vectors) -> DataFrame:
    """One row per classifier: mean and standard deviation of its accuracy over the folds.

    A classifier that fails is a row with its error, and the others go on.  Rows of ``counted`` are used as they are.
    """
    rows = rows if "counts" in rows.columns else counted(rows, **vectors)
    n, out = rows.count(), []
    for name in names:
        began = time.time()
        try:
            found = cross_validate(rows, chain(name, **vectors), folds)
            slicer = next(s for s in found.bestModel.stages if isinstance(s, VectorSlicer))
            out.append((name, round(float(found.avgMetrics[0]), 6), round(float(found.stdMetrics[0]), 6), len(slicer.getIndices()), n, time.time() - began, "success", None))
        except Exception as e:
            out.append((name, None, None, None, n, time.time() - began, "failed", f"{type(e).__name__}: {e}"[:300]))
    return rows.sparkSession.createDataFrame(out, RESULT)


def importances(rows: DataFrame, trees: int = 100, **vectors) -> DataFrame:
    """(feature, kind, importance, rank) of a random forest over all columns."""
    forest = RandomForestClassifier(numTrees=trees, maxDepth=10, seed=42, featuresCol="features", labelCol="label")
    model = Pipeline(stages=[*vector_stages(**vectors), forest]).fit(rows)
    value = model.stages[-1].featureImportances.toArray().tolist()  # one number per column
    ranked = sorted(zip(feature_names(model), value), key=lambda x: (-x[1], x[0]))
    kind = lambda f: "tfidf" if f.startswith("tfidf_") else "length" if f in fe.LENGTH_FEATURES else "category"
    return rows.sparkSession.createDataFrame([(f, kind(f), float(v), j) for j, (f, v) in enumerate(ranked, 1)],
                                             "feature string, kind string, importance double, rank int")


def importance_by_kind(ranked: DataFrame) -> DataFrame:
    """Sum, mean and number of the importances of each kind."""
    return ranked.groupBy("kind").agg(F.count(F.lit(1)).alias("n_features"), F.sum("importance").alias("total"), F.avg("importance").alias("mean"))
