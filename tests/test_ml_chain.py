import numpy as np
import pytest
from corpusflow.operators import features as fe
from corpusflow.operators import ml_chain as mc
from corpusflow.operators import score as sc
from corpusflow.operators import selection as se
from corpusflow.operators import spectral as sp
from corpusflow.plans import queries
from corpusflow.plans.retrain import retrain
from corpusflow.sources import store
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F
from test_queries_small import SF

RNG = np.random.default_rng(4)
WORDS = [["alpha", "beta", "gamma"], ["delta", "eps", "zeta"], ["eta", "theta", "iota"]]


def rows(spark, n=90, signal=0.8):
    """Three classes with words of their own, and a word that all share."""
    out = []
    for i in range(n):
        c = i % 3
        own = [str(w) for w in RNG.choice(WORDS[c], 6)] if RNG.random() < signal else [str(w) for w in RNG.choice(WORDS[(c + 1) % 3], 6)]
        out.append((i, float(c), (i // 3) % 3, [*own, "common", *([f"rare{i // 30}"] if i % 5 == 0 else [])]))
    out.append((n, 0.0, 0, []))
    d = spark.createDataFrame(out, "doc_id long, label double, fold int, terms array<string>")
    return d.withColumns({c: (F.col("doc_id") % 7).cast("double") if c in fe.LENGTH_FEATURES else F.lit(0.0) for c in mc.DENSE}).checkpoint()


@pytest.fixture(scope="module")
def data(spark):
    from corpusflow.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return rows(spark)


def test_vectors_equal_the_relational_tfidf_and_stay_sparse(spark, data):
    counts = data.select("doc_id", F.explode("terms").alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    vocab = fe.vocabulary(counts, data.count(), 2, 0.95, 8)
    want = {(r.doc_id, r.term): r.value for r in fe.tfidf(counts, vocab).collect()}
    model = mc.TfidfVectorizer(8).fit(data)
    names = model.stages[0].vocabulary
    got = {}
    for r in model.transform(data).select("doc_id", "tfidf").collect():
        assert isinstance(r.tfidf, SparseVector) and r.tfidf.size == len(names)
        got |= {(r.doc_id, names[int(j)]): float(v) for j, v in zip(r.tfidf.indices, r.tfidf.values) if v}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_selection_equals_the_relational_f_score(spark, data):
    model = mc.Pipeline(stages=mc.vector_stages(100)).fit(data)
    vectors = model.transform(data).checkpoint()
    names = mc.feature_names(model)
    score = mc.f_scores(vectors)
    long = spark.createDataFrame([(r.doc_id, names[int(j)], float(v)) for r in vectors.collect() for j, v in enumerate(r.features.toArray()) if v],
                                 "doc_id long, feature string, value double")
    want = {r.feature: r.score for r in se.f_score(long, data.select("doc_id", F.col("label").cast("long").alias("class_id"))).collect()}
    for name, s in zip(names, score):
        assert np.isnan(s) if want.get(name) is None else abs(s - want[name]) < 1e-6 * max(1, s)
    kept = mc.FScoreSelector(3).fit(vectors).getIndices()
    assert kept == sorted(np.argsort(-np.nan_to_num(score, nan=-1), kind="stable")[:3].tolist())
    assert mc.FScoreSelector(10_000).fit(vectors).transform(vectors).first().selected.size == (~np.isnan(score)).sum()


def test_cross_validation_by_hand(spark, data):
    found = mc.cross_validate(data, mc.chain("multinomial_nb", k=5))
    each = []
    for j in range(3):  # the fold's own vocabulary, selection and scaling
        model = mc.chain("multinomial_nb", k=5).fit(data.filter(F.col("fold") != j))
        each.append(model.transform(data.filter(F.col("fold") == j)).agg(mc.accuracy()).first()[0])
    assert np.isclose(found.avgMetrics[0], np.mean(each)) and np.isclose(found.stdMetrics[0], np.std(each))
    assert found.avgMetrics[0] > 0.6


def test_a_word_of_the_held_out_fold_is_not_in_the_vocabulary(spark, data):
    marked = data.withColumn("terms", F.when(F.col("fold") == 0, F.concat("terms", F.array(F.lit("leak")))).otherwise(F.col("terms")))
    assert "tfidf_leak" not in mc.feature_names(mc.chain("multinomial_nb", k=5).fit(marked.filter("fold <> 0")))


def test_comparison_goes_on_after_a_failure(spark, data, monkeypatch):
    own = mc.classifiers()
    broken = mc.Configured(lambda _: 1 / 0)
    monkeypatch.setattr(mc, "classifiers", lambda: {**own, "broken": (5, None, broken), "complement_nb": (3, *own["complement_nb"][1:])})
    got = {r.name: r for r in mc.compare(data, ["broken", "complement_nb"]).collect()}
    assert got["broken"].status == "failed" and "ZeroDivisionError" in got["broken"].error and got["broken"].mean_accuracy is None
    assert got["complement_nb"].status == "success" and got["complement_nb"].n_features == 3


def test_advice(spark):
    d = spark.createDataFrame([("logistic_regression", 0.5, 20.0, "success"), ("random_forest", 0.44, 5.0, "success"), ("nb", 0.42, 1.0, "success"),
                               ("slow", 0.3, 1.0, "success"), ("svm", None, 0.1, "failed")], "name string, mean_accuracy double, time_seconds double, status string")
    got = {r.advice: r.names for r in sc.comparison_advice(d).collect()}
    assert got == {"STRONG": "logistic_regression", "FOCUS_ON": "logistic_regression, random_forest, nb", "ITERATE_WITH": "random_forest, nb",
                   "COMBINE": "logistic_regression, random_forest", "TUNE": "logistic_regression", "REPAIR": "svm"}
    assert {r.advice for r in sc.comparison_advice(d.filter("name = 'svm'")).collect()} == {"NOT_ABOVE_BASELINE", "REPAIR"} - {"NOT_ABOVE_BASELINE"}


def test_registry_versions_and_equal_predictions(spark, data, tmp_path):
    registry = store.ModelRegistry(spark, str(tmp_path))
    assert registry.serving() is None and registry.published().count() == 0
    models = {v: mc.chain(name, k=4).fit(data) for v, name in (("v1", "multinomial_nb"), ("v2", "logistic_regression"))}
    for v, m in models.items():
        registry.save(m, v)
    assert registry.serving() is None  # saved is not published
    for v in ("v2", "v1"):
        registry.publish(v)
        assert registry.serving() == v
    for v, m in models.items():
        a, b = (x.transform(data).select("doc_id", "prediction", "probability").orderBy("doc_id").collect() for x in (m, registry.load(v)))
        assert a == b
    assert registry.published().count() == 2


def test_importance_by_kind(spark, data):
    ranked = mc.importances(data, trees=5)
    assert ranked.count() == len(set(r.feature for r in ranked.collect()))
    kinds = {r.kind: r for r in mc.importance_by_kind(ranked).collect()}
    assert abs(sum(k.total for k in kinds.values()) - 1) < 1e-9 and kinds["tfidf"].total > 0.5


def toy(spark):
    x = RNG.random((150, 25)) * (RNG.random((150, 25)) < 0.4)
    x[:, 3], x[:, 7], x[11] = 2 * x[:, 4], 1.0, 0.0
    cells = [(i, f"f{j:02}", float(x[i, j])) for i in range(150) for j in range(25) if x[i, j]]
    x[11, 7] = 0.0
    return x, spark.createDataFrame([c for c in cells if c[0] != 11], "doc_id long, feature string, value double").repartition(6)


def test_correlated_pairs_against_numpy(spark, monkeypatch):
    x, matrix = toy(spark)
    monkeypatch.setattr(sp, "BLOCK_CELLS", 100)  # several blocks per task
    index = sp.numbered_features(matrix.select("feature").distinct())
    got = {(r.feature_1, r.feature_2): r.r for r in sp.correlated_pairs(matrix, index, 25, 150).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 300 and all(abs(got[f"f{i:02}", f"f{j:02}"] - want[i, j]) < 1e-9 for i in range(25) for j in range(i + 1, 25))
    s = sp.pair_summary(sp.correlated_pairs(matrix, index, 25, 150)).first()
    assert s.pairs == 300 and s.max_abs_r == 1.0 and s.pairs_above_0_8 == 1
    advice = se.selection_advice(se.feature_variance(matrix, F.lit(150)), F.lit(25), spark.createDataFrame([(7,)], "pairs_above_0_8 long"))
    assert {r.strategy: r.n_features for r in advice.collect()}["REMOVE_CORRELATED"] == 7


def test_components_against_numpy(spark, monkeypatch):
    x, matrix = toy(spark)
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.svd(z, compute_uv=False) ** 2 / (150 * 25)
    monkeypatch.setattr(sp, "BLOCK_ENTRIES", 40)
    for k, spare in ((25, None), (6, 6)):
        got = sp.principal_components(matrix, 150, k, spare=spare).orderBy("component").collect()
        assert np.allclose([r.explained for r in got], want[:k], atol=1e-6) and np.allclose([r.cumulative for r in got], np.cumsum(want[:k]), atol=1e-6)
    needed = {r.share: r.components for r in sp.components_needed(sp.principal_components(matrix, 150, 25)).collect()}
    assert needed == {s: int(np.argmax(np.cumsum(want) >= s)) + 1 for s in (0.8, 0.9, 0.95)}
    assert {r.components for r in sp.components_needed(sp.principal_components(matrix, 150, 2)).collect()} == {None}
    assert sp.principal_components(matrix.limit(0), 150).count() == 0


def test_retraining_publishes_or_blocks(spark, tmp_path):
    raw = queries._raw(spark, SF)
    done = retrain(spark, raw, f"{tmp_path}/job")
    steps = {r.step: r for r in done.runs.table().collect()}
    assert done.status == "published" and done.registry.serving() == done.run_id
    assert steps["create_clean_dataset"].value == queries._clean(spark, SF).count() and all(r.status == "success" for r in steps.values()) and len(steps) == 6
    before = done.registry.serving()
    again = retrain(spark, raw, f"{tmp_path}/job", least_accuracy=1.01)
    assert again.status == "blocked" and again.registry.serving() == before
    last = again.runs.table().filter(F.col("run_id") == again.run_id).orderBy(F.desc("step_no")).first()
    assert (last.step, last.status) == ("validate_model", "failed")
    nothing = retrain(spark, raw.limit(0), f"{tmp_path}/job")
    assert nothing.status == "blocked" and nothing.registry.serving() == before
    assert {r.run_id: r.status for r in done.notices().collect()} == {done.run_id: "published", again.run_id: "blocked", nothing.run_id: "blocked"}
