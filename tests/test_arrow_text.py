"""Text steps and word n-grams in Arrow batches give what the regexes and arrays of terms give."""
import pytest
from corpusflow.functions import arrow_text as at
from corpusflow.functions import text as tx
from corpusflow.operators import features as fe
from corpusflow.operators import ml_chain as mc
from corpusflow.operators import term_blocks as tb
from corpusflow.plans import pipeline as pl
from pyspark.sql import functions as F
from test_term_counts import docs
from test_text_passes import texts

STOPS = ("a", "b1", "prn")


def test_texts_in_batches_equal_the_regexes(spark):
    d = texts(spark)
    pairs = [(at.clean_text("t", legacy), tx.clean_text("t", legacy)) for legacy in (False, True)]
    pairs += [(at.expanded("t", dates, phones), tx.expanded("t", dates, phones)) for dates in (False, True) for phones in (False, True)]
    pairs += [(at.joined_tokens("t", stops), tx.joined_tokens("t", tx.ASCII_TOKEN, stops)) for stops in (None, STOPS)]
    pairs += [(at.has_artifact("t", n), tx.has_artifact("t", n)) for n in at.SWITCHES] + [(at.word_count("t"), tx.word_count("t"))]
    for got, want in pairs:
        assert d.select("t", got.alias("got"), want.alias("want")).filter("not got <=> want").collect() == []


@pytest.mark.parametrize("ngram,most", [((1, 2), 1 << 20), ((1, 3), 60), ((2, 4), 1)])
def test_blocks_of_documents_equal_the_arrays_of_terms(spark, monkeypatch, ngram, most):
    monkeypatch.setattr(tb, "BLOCK_CHARS", most)
    made = [(i, i % 3 if i % 7 else None, " ".join(f"w{(i * k) % 5}" for k in range(i % 9))) for i in range(40)] + [(90, 1, None), (91, 1, ""), (92, 2, "x")]
    d = spark.createDataFrame(made, "doc_id long, fold int, j string").repartition(3)
    arrays = d.select("doc_id", "fold", fe.ngrams_of(ngram).alias("terms"))
    learnt, learnt_arrays = d.filter("fold is not null"), arrays.filter("fold is not null")
    want = sorted(map(tuple, fe.term_stats(learnt_arrays, (0, 1)).collect()))
    assert sorted(map(tuple, tb.term_stats(learnt, ngram, 64, (0, 1)).collect())) == want and len(want) > 9
    sums = tb.bucket_sums(learnt, ngram, 64, (0, 1))
    assert sums.agg(F.sum("cf"), F.sum("cf_0"), F.sum("cf_1")).first() == learnt_arrays.agg(
        F.sum(F.size("terms")), F.sum(F.when(F.col("fold") == 0, F.size("terms"))), F.sum(F.when(F.col("fold") == 1, F.size("terms")))).first()
    half = [tuple(r) for r in tb.term_stats(learnt, ngram, 64, (0, 1), sums.filter("bucket < 32")).collect()]
    assert set(half) < set(want)
    vocab = fe.vocabulary_of(fe.term_stats(arrays), 43, 2, 0.95, 30).orderBy("feature_index").collect()
    for counts_only in (False, True):
        got = {r.doc_id: dict(zip(r.v["indices"], r.v["values"])) for r in tb.term_vectors(d, vocab, ngram, counts_only).collect()}
        plain = {r.doc_id: dict(zip(r.v.indices.tolist(), r.v.values.tolist())) for r in fe.term_vectors(arrays.na.fill("").select("doc_id", F.coalesce("terms", F.array()).alias("terms")), vocab, counts_only).collect()}
        assert got.keys() == plain.keys() and all(got[k].keys() == plain[k].keys() and all(abs(got[k][i] - x) < 1e-12 for i, x in plain[k].items()) for k in plain)


def test_chains_count_blocks_where_arrays_are_counted(spark, monkeypatch):
    rows = mc.vector_rows(pl.build_features(docs(spark, range(6))), 2)
    plain = mc.counted(rows.drop("j"), min_df=1).orderBy("doc_id").collect()
    monkeypatch.setattr(fe, "term_stats", None)  # no array of terms is counted
    assert mc.counted(rows, min_df=1).orderBy("doc_id").select(*plain[0].__fields__).collect() == plain
