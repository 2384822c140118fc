"""Character n-grams counted in blocks of documents give what arrays of n-grams give."""
import random

import pytest
from corpusflow.operators import char_blocks as cb
from corpusflow.operators import features as fe
from corpusflow.operators import ml_chain as mc
from pyspark.sql import functions as F

LETTERS = ["a", "b", " ", "\0", "é", "€", "ж", "\n"]


def texts(spark):
    rng = random.Random(5)
    made = [(i, i % 2, "".join(rng.choices(LETTERS[:3] if i % 3 else LETTERS, k=rng.randint(0, 40)))) for i in range(60)] + [(60, 0, ""), (61, 1, None)]
    return spark.createDataFrame(made, "doc_id long, fold int, j string").repartition(3).persist()


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_blocks_equal_arrays(spark, monkeypatch, block):
    monkeypatch.setattr(cb, "BLOCK_CHARS", block)
    d = texts(spark)
    arrays = d.select("doc_id", "fold", fe.ngrams_of((2, 4), "char").alias("terms"))
    got = cb.term_stats(d, (2, 4, "char"), 1 << 20, (0, 1))
    assert sorted(got.collect()) == sorted(fe.term_stats(arrays, (0, 1)).select(got.columns).collect())
    sums = {r.bucket: r for r in cb.bucket_sums(d, (2, 4, "char"), 16, (0, 1)).collect()}
    total = got.agg(F.sum("cf"), F.sum("cf_0"), F.sum("cf_1")).first()
    assert [sum(r[c] for r in sums.values()) for c in ("cf", "cf_0", "cf_1")] == list(total) and len(sums) == 16
    chosen = cb.term_stats(d, (2, 4, "char"), 16, only=spark.createDataFrame([(3,), (9,)], "bucket long"))
    assert chosen.agg(F.sum("cf")).first()[0] == sums[3].cf + sums[9].cf
    vocab = fe.vocabulary_of(got, 62, 2, 0.95, 40).orderBy("feature_index").collect()
    for counts_only in (True, False):
        want = {r.doc_id: r.v.toArray().tolist() for r in fe.term_vectors(arrays, vocab, counts_only).collect()}
        for r in cb.term_vectors(d, vocab, (2, 4, "char"), counts_only).collect():
            dense = [0.0] * r.v["size"]
            for i, x in zip(r.v["indices"], r.v["values"]):
                dense[i] = x
            assert dense == pytest.approx(want[r.doc_id], abs=1e-12)


def test_chains_read_characters_as_blocks(spark):
    d = texts(spark).withColumn("label", (F.col("doc_id") % 3).cast("double"))
    rows = mc.with_ngrams(d, (2, 3), "char")
    assert mc._ngram(rows) == (2, 3, "char") and mc._ngram(mc.with_ngrams(d, (1, 5))) is None
    kw = {"max_features": 30, "counts_only": True, "dense": []}
    got, want = (mc.compare(x, ["multinomial_nb"], folds=2, **kw).drop("time_seconds").first() for x in (rows, rows.drop("j")))
    assert got == want and got.status == "success"
