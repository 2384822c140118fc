"""Fewer passes over the texts: guards and shorter patterns give what the plain patterns give."""
import itertools
import random

from corpusflow.functions import text as tx
from corpusflow.operators import profile as pr
from corpusflow.plans import pipeline as pl
from pyspark.sql import functions as F

PIECES = ["a", "b1", "9", "_", ".", "..", "!?", " ", "  ", "\n", "\x1c", "é", "“", "°", "p.o.", "iv", "q.i.d", "prn.", "Stat", "date: x", "555-123-4567", ".5"]


def texts(spark, n=1500):
    rng = random.Random(7)
    made = ["".join(rng.choices(PIECES, k=rng.randint(0, 9))) for _ in range(n)] + ["".join(p) for p in itertools.product(PIECES, repeat=2)] + [None]
    return spark.createDataFrame([(t,) for t in made], "t string").repartition(4).persist()


def _plain_clean(c, pairs):
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.trim(F.regexp_replace(F.regexp_replace(c, tx.NON_ASCII, ""), tx.WS_RUN, " "))
    return F.regexp_replace(c, r"([.!?]){2,}", "$1")


def _plain_expanded(c):
    c = F.lower(F.coalesce(c, F.lit("")))
    for pattern, full in [(tx.DATE_LABEL_REMOVE, ""), (tx.PHONE_REMOVE, ""), *tx.ABBREVIATIONS]:
        c = F.regexp_replace(c, pattern, full)
    return c


def test_cleaning_equals_the_plain_patterns(spark):
    d = texts(spark)
    for legacy in (False, True):
        pairs = tx.SYMBOL_WORDS if legacy else tx.SYMBOL_WORDS + tx.CURLY_QUOTES
        assert d.filter(~tx.clean_text("t", legacy).eqNullSafe(_plain_clean(F.col("t"), pairs))).isEmpty()
    assert d.filter(~tx.collapse_ws("t").eqNullSafe(F.trim(F.regexp_replace("t", tx.WS_RUN, " ")))).isEmpty()


def test_tokens_need_no_stripped_punctuation(spark):
    d = texts(spark)
    assert d.filter(~tx.expanded("t", True, True).eqNullSafe(_plain_expanded(F.col("t")))).isEmpty()
    stripped = F.trim(F.regexp_replace(_plain_expanded(F.col("t")), r"(?:[^\w.]++|\.(?!\d))++", " "))
    assert d.filter(~tx.strip_punct(_plain_expanded(F.col("t"))).eqNullSafe(stripped)).isEmpty()
    assert d.filter(~tx.tokens(tx.expanded("t", True, True), tx.ASCII_TOKEN).eqNullSafe(tx.tokens(stripped))).isEmpty()


def test_switches_equal_the_counted_hits(spark):
    for made in (["none"], ["Date : x"], ["5551234567"], ["TIME- 555 123 4567", None], [None], ["candidate: 1", "15551234567"]):
        d = spark.createDataFrame([(t,) for t in made], "transcription string")
        want = tuple(bool(d.agg(F.max(tx.artifact_hits("transcription", n))).first()[0]) for n in ("date_labels", "phone_numbers"))
        assert pr.artifact_flags(d) == want == tuple(d.select(*pr.artifact_switches(d)).first())


def test_prepared_texts_skip_what_is_switched_off(spark):
    d = spark.createDataFrame([(1, "en", "s", "d", "Take p.o. daily.", "x")], "doc_id long, lang string, sample_name string, description string, transcription string, medical_specialty string")
    plan = pl.prepare_docs(d)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and tx.PHONE_REMOVE not in plan
    assert pl.prepare_docs(d).first().transcription_cleaned == "take oral daily" and pl.prepare_docs(d).first().transcription_expanded == "take oral. daily."
