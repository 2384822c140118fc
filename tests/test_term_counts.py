"""Terms counted inside rows: same results as the long table of counts, without shuffling (doc, term) pairs."""
import re

import numpy as np
import pytest
from corpusflow.functions import text as tx
from corpusflow.operators import features as fe
from corpusflow.operators import ml_chain as mc
from corpusflow.plans import pipeline as pl
from corpusflow.plans import queries
from pyspark.sql import functions as F
from test_ml_chain import rows as ml_rows

TEXTS = ["alpha beta alpha gamma", "beta gamma delta beta", "alpha", "", "gamma gamma delta eps alpha beta", "eps zeta"]


def docs(spark, ids):
    made = [(i, "ab"[k % 2], "s", "d", t, t, "d") for k, (i, t) in enumerate(zip(ids, TEXTS))]
    return spark.createDataFrame(made, "doc_id long, label string, sample_name string, description string, transcription string, "
                                       "transcription_cleaned string, description_cleaned string").repartition(3)


def close(a, b):
    a, b = ({tuple(r)[:2]: tuple(r)[2] for r in d.collect()} for d in (a, b))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("ids", [[1, 2, 3, 4, 5, 6], [1, 1, 2, 2, 1, None]])
@pytest.mark.parametrize("analyzer,ngram", [("word", (1, 2)), ("char", (3, 4))])
def test_features_equal_the_long_counts(spark, ids, analyzer, ngram):
    d = docs(spark, ids)
    kw = {"max_features": 7, "min_df": 2, "max_df": 0.95, "ngram": ngram, "analyzer": analyzer}
    fast, plain = pl.build_features(d, **kw), pl.build_features(d, persist=False, **kw)
    assert sorted(fast.vocab.collect()) == sorted(plain.vocab.collect()) and fast.vocab.count() > 1
    close(fast.tfidf, plain.tfidf)
    close(fast.term_matrix, fe.count_matrix(plain.counts, plain.vocab))
    assert "counts" not in vars(fast)


def test_no_pair_of_document_and_term_is_shuffled(spark):
    f = pl.build_features(docs(spark, range(6)))
    shuffled = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", fe.term_stats(f.whole_rows)._jdf.queryExecution().toString())
    assert shuffled and all("doc_id" not in s for s in shuffled)
    assert "Exchange hashpartitioning" not in f.tfidf._jdf.queryExecution().toString()


def test_per_document_counts_with_and_without_repeated_ids(spark, tmp_path):
    for name, ids in (("once", [1, 2, 3, 4]), ("twice", [1, 1, 2, 3])):
        made = [(i, t, "en", "s", len(t)) for i, t in zip(ids, ["one two one two three", "two four", "... !", "five five"])]
        spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        d = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = sorted(map(tuple, queries._per_doc(spark, f"{tmp_path}/{name}", d, "text", ngram=(1, 3)).collect()))
        want = fe.term_counts(d, "text", ngram=(1, 3)).groupBy("doc_id").agg(F.count("*"), F.sum("tf"))
        assert got == sorted(map(tuple, want.collect())) and len(got) == (3 if name == "once" else 2)


def test_counted_rows_fit_the_same_chains(spark):
    data = ml_rows(spark)
    for kw in ({"max_features": 8}, {"max_features": 6, "counts_only": True, "dense": []}):
        short = mc.counted(data, **kw)
        assert "terms" not in short.columns and short.count() == data.count()
        for cond in ("fold <> 0", "fold <> 2", "fold >= 0"):
            long, own = mc.Pipeline(stages=mc.vector_stages(**kw)).fit(data.filter(cond)), mc.Pipeline(stages=mc.vector_stages(**kw)).fit(short.filter(cond))
            first = long.stages[0].stages
            want = dict(zip(first[0].vocabulary, first[1].getScalingVec().toArray() if len(first) > 1 else np.ones(99)))
            weight = own.stages[0].stages[0].getScalingVec().toArray()
            assert np.allclose(sorted(w for w in weight if w), sorted(want.values()))
            score, here = mc.f_scores(long.transform(data.filter(cond))), mc.f_scores(own.transform(short.filter(cond)))
            known = weight != 0
            assert np.allclose(score[:len(want)], here[:len(weight)][known], equal_nan=True) and np.isnan(here[:len(weight)][~known]).all()
            assert np.allclose(score[len(want):], here[len(weight):], equal_nan=True)
    doubled = data.union(data)
    assert mc.counted(doubled) is doubled


def _keys(rows):
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("buckets,folds", [(64, (0, 1)), (1 << 20, ())])
def test_terms_outside_a_bounded_vocabulary_are_not_counted(spark, monkeypatch, buckets, folds):
    # Word i comes i times in all, in up to 4 of 6 documents; one word is in too many documents.
    made = [(d, d % 2, [f"w{i:02d}" for i in range(60) for _ in range((i + d) // 4 if d < 4 else 0)] + ["all"] * 40) for d in range(6)]
    arrays = spark.createDataFrame(made, "doc_id int, fold int, terms array<string>").repartition(3)
    monkeypatch.setattr(fe, "BUCKETS", buckets)
    whole = fe.term_stats(arrays, folds)
    n_docs = {None: 6, **{j: 3 for j in folds}}
    for most in (5, 100):
        limits = (2, 0.99, most)
        stats = fe.vocabulary_stats(arrays, n_docs, *limits)
        for j, n in n_docs.items():
            part = [F.col(c) - (F.lit(0) if j is None else F.col(f"{c}_{j}")) for c in ("df", "cf")]
            cut = lambda t: t.select("term", part[0].alias("df"), part[1].alias("cf"))
            assert _keys(fe.vocabulary_of(cut(stats), n, *limits).collect()) == _keys(fe.vocabulary_of(cut(whole), n, *limits).collect())
        assert stats.exceptAll(whole).isEmpty()
        if buckets > 100 and most < 100:
            assert stats.count() < whole.count()


def test_what_chains_read_is_written_without_ngrams(spark):
    before = set(spark.sparkContext._jvm.java.io.File(pl.ensure_checkpoint_dir(spark)).list())
    f = pl.build_features(docs(spark, range(6)))
    rows = mc.vector_rows(f, 2)
    assert rows.count() == 6 and "terms" in rows.columns
    after = set(spark.sparkContext._jvm.java.io.File(pl.ensure_checkpoint_dir(spark)).list()) - before
    assert after and all("terms" not in spark.read.parquet(f"{pl.ensure_checkpoint_dir(spark)}/{t}").columns for t in after)


def test_tokens_without_stop_words(spark):
    made = spark.createDataFrame([("the cat and the hat",), ("the",), ("",), (None,), ("then and",)], "t string")
    got = [r[0] for r in made.select(tx.joined_tokens("t", stop_words=["the", "and"])).collect()]
    assert got == ["cat hat", "", "", "", "then"]


def test_normalisation_equals_the_patterns_one_by_one(spark):
    texts = ["Date: 1/2/2020, p.o. bid. b.i.d Stat prn", "a.b .5 1.5 5. ...6 x_y\t\x1c-z", "tel 555-123-4567 .", " .. ", "é.1 ü", None, "time - now t.i.d q.i.d iv i.v. stat."]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.lower(F.coalesce("t", F.lit("")))
    for pattern, full in [(tx.DATE_LABEL_REMOVE, ""), (tx.PHONE_REMOVE, ""), *tx.ABBREVIATIONS]:
        c = F.regexp_replace(c, pattern, full)
    strip = lambda c: tx.collapse_ws(F.regexp_replace(F.regexp_replace(c, f"[^\\w{tx.WS_CLASS}.]", " "), r"\.(?!\d)", " "))
    simple = tx.collapse_ws(F.regexp_replace(F.lower(F.coalesce("t", F.lit(""))), f"[^\\w{tx.WS_CLASS}]", " "))
    for got, want in ((tx.normalize_conservative("t", True, True), strip(c)), (tx.strip_punct("t"), strip(F.col("t"))), (tx.normalize_simple("t"), simple)):
        assert d.select(got).collect() == d.select(want).collect()


def test_counted_rows_are_compared_as_they_are(spark):
    data, kw = ml_rows(spark), {"max_features": 8}
    got, want = (mc.compare(d, ["multinomial_nb"], **kw).drop("time_seconds").collect() for d in (mc.counted(data, **kw), data))
    assert got == want and got[0].status == "success"
