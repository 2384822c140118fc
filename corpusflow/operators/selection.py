"""Feature analysis and selection over the long matrix ``(doc_id, feature, value)``.

All scores are built from a few sums per ``(feature, class)`` with the class
sizes ``n_c`` coming from the label table, so implicit zeros (features absent
from a document) are accounted for without densifying.  The per-class tables
are bounded by the number of classes and broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.features import LENGTH_FEATURES


def _kind(col="feature"):
    return (F.when(F.col(col).startswith("tfidf_"), F.lit("tfidf"))
            .when(F.col(col).isin(LENGTH_FEATURES), F.lit("length")).otherwise(F.lit("other")))


def feature_moments(matrix: DataFrame) -> DataFrame:
    """Per feature: nnz, sum, sum of squares, min, max over stored (nonzero) cells."""
    return matrix.groupBy("feature").agg(
        F.count(F.lit(1)).alias("nnz"), F.sum("value").alias("s1"),
        F.sum(F.col("value") * F.col("value")).alias("s2"),
        F.min("value").alias("mn"), F.max("value").alias("mx"))


def feature_variance(matrix: DataFrame, n_docs, threshold: float = 0.01) -> DataFrame:
    """Population variance per feature (implicit zeros included)."""
    m = feature_moments(matrix)
    mean = F.col("s1") / n_docs
    var = F.greatest(F.col("s2") / n_docs - mean * mean, F.lit(0.0))
    return m.select("feature", _kind().alias("kind"), "nnz", mean.alias("mean"), var.alias("variance"),
                    (var < threshold).alias("low_variance"))


def variance_report(variances: DataFrame) -> DataFrame:
    """Counts and summary of variances per feature kind and for all features (rollup)."""
    r = variances.rollup("kind").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum(F.col("low_variance").cast("long")).alias("n_low_variance"),
        F.min("variance").alias("min_variance"), F.max("variance").alias("max_variance"),
        F.avg("variance").alias("mean_variance"),
        F.percentile("variance", 0.5).alias("median_variance"))
    return r.select(F.coalesce("kind", F.lit("all")).alias("kind"), "n_features", "n_low_variance",
                    *[F.round(c, 9).alias(c) for c in
                      ("min_variance", "max_variance", "mean_variance", "median_variance")])


def constant_features(matrix: DataFrame, n_docs) -> DataFrame:
    """Features whose value is the same in every document (exact test: present in all
    documents with min = max)."""
    m = feature_moments(matrix)
    return m.filter((F.col("nnz") == n_docs) & (F.col("mn") == F.col("mx"))).select("feature")


def drop_constant_features(matrix: DataFrame, n_docs) -> DataFrame:
    return matrix.join(F.broadcast(constant_features(matrix, n_docs)), "feature", "left_anti")


def class_sizes(labels: DataFrame, class_col: str = "class_id") -> DataFrame:
    return labels.groupBy(F.col(class_col).alias("class_id")).agg(F.count(F.lit(1)).alias("n_c"))


def class_feature_sums(matrix: DataFrame, labels: DataFrame, class_col: str = "class_id") -> DataFrame:
    """Per (feature, class): count of nonzeros, sum, sum of squares.

    The label table is one row per document; the join is on doc_id (both
    sides shuffled once), followed by a partially-aggregated groupBy.
    """
    lab = labels.select("doc_id", F.col(class_col).alias("class_id"))
    j = matrix.join(lab, "doc_id")
    return j.groupBy("feature", "class_id").agg(
        F.count(F.lit(1)).alias("a"), F.sum("value").alias("s1"),
        F.sum(F.col("value") * F.col("value")).alias("s2"))


def f_score(matrix: DataFrame, labels: DataFrame, class_col: str = "class_id") -> DataFrame:
    """One-way ANOVA F statistic per feature (between / within class mean squares)."""
    sizes = class_sizes(labels, class_col)
    n = sizes.select(F.sum("n_c")).scalar()
    k = sizes.select(F.count(F.lit(1))).scalar()
    cs = class_feature_sums(matrix, labels, class_col).join(F.broadcast(sizes), "class_id")
    per_f = cs.groupBy("feature").agg(
        F.sum("s1").alias("s1"), F.sum("s2").alias("s2"),
        F.sum(F.col("s1") * F.col("s1") / F.col("n_c")).alias("between_raw"))
    ss_between = F.col("between_raw") - F.col("s1") * F.col("s1") / n
    ss_total = F.col("s2") - F.col("s1") * F.col("s1") / n
    ss_within = ss_total - ss_between
    msb = ss_between / (k - 1)
    msw = ss_within / (n - k)
    score = F.when(msw > 0, msb / msw)
    return per_f.select("feature", score.alias("score"))


def chi2_score(matrix: DataFrame, labels: DataFrame, class_col: str = "class_id") -> DataFrame:
    """chi2 of class sums vs expectation ``p_c * total_f`` (non-negative features)."""
    sizes = class_sizes(labels, class_col)
    n = sizes.select(F.sum("n_c")).scalar()
    cs = class_feature_sums(matrix, labels, class_col).join(F.broadcast(sizes), "class_id")
    tot = cs.groupBy("feature").agg(F.sum("s1").alias("t"),
                                    F.sum(F.col("s1") * F.col("s1") / (F.col("n_c") / n)).alias("q"))
    return tot.select("feature", F.when(F.col("t") > 0, F.col("q") / F.col("t") - F.col("t")).alias("score"))


def mutual_info(matrix: DataFrame, labels: DataFrame, class_col: str = "class_id") -> DataFrame:
    """Mutual information (nats) between feature presence and class, from counts.

    Present cells come from the (feature, class) sums; absent cells of classes
    where the feature never occurs are added in closed form, so no
    feature x class grid is materialised.
    """
    sizes = class_sizes(labels, class_col)
    n = sizes.select(F.sum("n_c")).scalar()
    cs = class_feature_sums(matrix, labels, class_col).join(F.broadcast(sizes), "class_id")
    per_f = cs.groupBy("feature").agg(F.sum("a").alias("df"), F.collect_list(
        F.struct("a", "n_c")).alias("cells"), F.sum("n_c").alias("n_present_classes"))
    # The lambda below may only see columns, so n is attached as a column first.
    per_f = per_f.withColumn("__n", n.cast("double"))
    nn = F.col("__n")
    p1 = F.col("df") / nn
    p0 = F.lit(1.0) - p1

    def term(p_xc, p_x, p_c):
        return F.when(p_xc > 0, p_xc * F.log(p_xc / (p_x * p_c))).otherwise(F.lit(0.0))

    cells = F.aggregate("cells", F.lit(0.0), lambda acc, c: acc
                        + term(c["a"] / nn, p1, c["n_c"] / nn)
                        + term((c["n_c"] - c["a"]) / nn, p0, c["n_c"] / nn))
    missing = (nn - F.col("n_present_classes")) / nn
    absent_rest = F.when((missing > 0) & (p0 > 0), missing * F.log(F.lit(1.0) / p0)).otherwise(F.lit(0.0))
    return per_f.select("feature", (cells + absent_rest).alias("score"))


def select_k_best(scores: DataFrame, k: int) -> DataFrame:
    """The k highest scores (ties by feature name), with their rank; at most k rows."""
    top = scores.filter(F.col("score").isNotNull()).orderBy(F.desc("score"), F.asc("feature")).limit(k)
    return top


def selector_overlap(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """|top-k(a) ∩ top-k(b)| / k."""
    ta = select_k_best(a, k).select("feature")
    tb = select_k_best(b, k).select("feature")
    inter = ta.join(tb, "feature")
    return inter.agg(F.count(F.lit(1)).alias("shared")).select(
        "shared", F.lit(k).alias("k"), (F.col("shared") / F.lit(float(k))).alias("agreement"))


def dimensionality(n_docs, n_features, n_classes, spark) -> DataFrame:
    """n, d, n/d, classes and a HIGH / MEDIUM / OK risk."""
    one = spark.range(1).select(n_docs.alias("n_samples"), n_features.alias("n_features"),
                                n_classes.alias("n_classes"))
    risk = (F.when(F.col("n_features") > F.col("n_samples"), F.lit("HIGH"))
            .when(F.col("n_features") > 0.5 * F.col("n_samples"), F.lit("MEDIUM")).otherwise(F.lit("OK")))
    return one.select("n_samples", "n_features", F.round(F.col("n_samples") / F.col("n_features"), 6)
                      .alias("samples_per_feature"), "n_classes", risk.alias("risk"))


def model_advice(dims: DataFrame, matrix_stats: DataFrame) -> DataFrame:
    """Rule rows: which model families the data shape favours."""
    d = dims.select(F.struct("*")).scalar()
    m = matrix_stats.select(F.struct("*")).scalar()
    rules = [
        (d["n_features"] > d["n_samples"], "HIGH_DIMENSIONAL", "regularised linear models or naive Bayes"),
        (d["n_features"] > 1000, "MANY_FEATURES", "feature selection before distance-based models"),
        (d["n_classes"] > 10, "MANY_CLASSES", "models with native multi-class support"),
        ((m["min"] >= 0) & (m["max"] <= 1), "UNIT_RANGE", "multinomial naive Bayes works on these values"),
        (d["n_samples"] < 5000, "SMALL_SAMPLE", "simple models and cross-validation"),
        (m["density_pct"] < 10, "SPARSE", "sparse-aware models (naive Bayes, linear)"),
    ]
    spark = dims.sparkSession
    base = spark.range(1)
    out = None
    for i, (cond, rule, advice) in enumerate(rules):
        r = base.select(F.lit(i).alias("order"), F.lit(rule).alias("rule"), F.lit(advice).alias("advice"),
                        cond.alias("fires"))
        out = r if out is None else out.unionByName(r)
    return out.filter(F.col("fires")).drop("fires")


def selection_advice(variances: DataFrame, n_features, corr_summary: DataFrame | None = None) -> DataFrame:
    """Ordered strategies with counts: drop low-variance features, drop correlated ones,
    univariate selection when d is large."""
    low = variances.select(F.sum(F.col("low_variance").cast("long"))).scalar()
    zero = variances.select(F.sum((F.col("variance") == 0).cast("long"))).scalar()
    spark = variances.sparkSession
    rows = spark.range(1).select(
        F.array(
            F.when(zero > 0, F.struct(F.lit(1).alias("order"), F.lit("REMOVE_CONSTANT").alias("strategy"),
                                      zero.cast("long").alias("n_features"))),
            F.when(low > 0, F.struct(F.lit(2).alias("order"), F.lit("REMOVE_LOW_VARIANCE").alias("strategy"),
                                     low.cast("long").alias("n_features"))),
            F.when(n_features > 1000, F.struct(F.lit(4).alias("order"), F.lit("UNIVARIATE_SELECTION")
                                               .alias("strategy"), n_features.cast("long").alias("n_features"))),
        ).alias("a"))
    if corr_summary is not None:
        hc = corr_summary.select("pairs_above_0_8").scalar()
        rows = rows.select(F.concat("a", F.array(F.when(hc > 0, F.struct(
            F.lit(3).alias("order"), F.lit("REMOVE_CORRELATED").alias("strategy"),
            hc.cast("long").alias("n_features"))))).alias("a"))
    return rows.select(F.explode(F.filter("a", lambda x: x.isNotNull())).alias("s")).select("s.*")
