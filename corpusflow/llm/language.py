"""Language ID: nearest centroid over TF-IDF character n-grams.

A text's vector counts its letter 1-, 2- and 3-grams (words padded with a space)
in ``SIZE`` hash buckets, damped by a logarithm, times the buckets' inverse
document frequency, at length 1.  Every language has up to ``CLUSTERS``
centroids from spherical k-means; a text gets the language of the centroid with
the highest cosine.  Texts farther from their centroid than nearly all of the
texts it was made of are marked ``rejected``.

What is bounded: centroids are fitted on about ``MAX_ROWS`` documents per
language, drawn by hash (``SIZE`` numbers each, one language per task).  The
document frequencies count all documents that may be learnt from.  The model,
languages x clusters x ``SIZE`` numbers, is broadcast.  Every text is read whole.

Defined cases: a null text or one without a letter is ``und`` with score 0 (a
letter is what Unicode calls one); ties go to the language that sorts first;
null languages are not learnt; if there is nothing to learn from, all are
``und``; repeated rows get the same result; a null doc_id is predicted, never
learnt from and not held out; an empty table gives an empty result; lang and
source are not read when predicting.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import read, ship_package, stored

BITS, CLUSTERS, MAX_ROWS, ROUNDS, REJECT = 13, 4, 1_000, 12, 0.005
SIZE = 1 << BITS
#: Odd multipliers that mix the code points of an n-gram.
MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

_LETTERS: list[np.ndarray] = []


def is_letter(points: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), dtype=bool, count=1 << 16))
    out = _LETTERS[0][np.minimum(points, 0xFFFF)]
    if (far := points > 0xFFFF).any():
        out[far] = [chr(c).isalpha() for c in points[far]]
    return out


def gram_counts(text: str | None) -> np.ndarray | None:
    """Damped counts of the text's n-grams by bucket; None without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = is_letter(points) if len(points) else np.zeros(0, bool)
    if not letters.any():
        return None
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    spaced = np.where(letters, points, 32)[keep]
    x = np.concatenate([[32], spaced, [32]] if spaced[0] != 32 else [spaced, [32]]).astype(np.uint64)
    one = x * MIX[0]
    two = one[:-1] ^ (x[1:] * MIX[1])
    three = two[:-1] ^ (x[2:] * MIX[2])
    codes = np.concatenate([one, two, three])
    codes = ((codes ^ (codes >> np.uint64(29))) * MIX[3]) >> np.uint64(64 - BITS)
    return np.log1p(np.bincount(codes.astype(np.int64), minlength=SIZE)).astype(np.float32)


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: centroids, and each row's cosine to its own."""
    centres = [unit(x.mean(0))]
    best = x @ centres[0]
    seeds = []
    for _ in range(k):
        seeds.append(x[int(np.argmin(best))])
        best = np.maximum(best, x @ seeds[-1])
    c = np.stack(seeds)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = np.stack([unit(x[own == j].sum(0)) if (own == j).any() else c[j] for j in range(k)])
    cosine = x @ c.T
    return c, np.stack([np.argmax(cosine, 1), cosine.max(1)], 1)


def learnable(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != fold, F.lit(False))


class Centroids:
    def __init__(self, idf: np.ndarray, langs: list[str], centres: np.ndarray, least: np.ndarray):
        self.idf, self.langs, self.centres, self.least = idf, langs, centres, least

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        if not self.langs:
            return out
        for k in range(0, len(texts), 128):
            rows = [(j, v) for j, t in enumerate(texts[k:k + 128], k) if (v := gram_counts(t)) is not None]
            if rows:
                cosine = unit(np.stack([v for _, v in rows]) * self.idf) @ self.centres.T
                for (j, _), best, top in zip(rows, np.argmax(cosine, 1), cosine.max(1)):
                    out[j] = (self.langs[best], float(min(1.0, max(0.0, top))), bool(top < self.least[best]))
        return out


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per bucket, and their number: each task sends one sum per bucket."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE, dtype=np.int64), 0
        for batch in found:
            for t in batch.column(0):
                v = gram_counts(t.as_py())
                if v is not None:
                    total += v > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*at, SIZE], pa.int32()), pa.array([*total[at], n], pa.int64())], names=["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE + 1, dtype=np.int64)
    for r in sums.collect():
        out[r.bucket] = r.n
    return out[:SIZE], int(out[SIZE])


def fit(docs: DataFrame, max_rows: int = MAX_ROWS, clusters: int = CLUSTERS) -> Centroids:
    """Learn from text and lang of the documents that are not held out."""
    spark = docs.sparkSession
    ship_package(spark)
    known = docs.select("doc_id", "text", "lang").where(learnable(F.col("doc_id")) & F.col("lang").isNotNull())
    found, n = document_frequencies(known.select("text"))
    idf = (np.log((1 + n) / (1 + found)) + 1).astype(np.float32)
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Centroids(idf, [], np.zeros((0, SIZE)), np.zeros(0))
    draw = F.pmod(F.xxhash64(F.lit(21), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    rates = spark.createDataFrame([(k, max_rows / v) for k, v in sizes.items()], "l string, rate double")
    # One row per language.
    sample = stored(known.join(F.broadcast(rates), F.col("lang") == F.col("l")).where(draw < F.col("rate")).select("lang", "text"), "sample")

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = [v for v in map(gram_counts, rows["text"]) if v is not None]
        if not vectors:
            return pd.DataFrame({"lang": [], "centre": [], "least": []})
        x = unit(np.stack(vectors) * idf)
        centres, own = k_means(x, min(clusters, len(x)))
        least = [float(np.quantile(own[own[:, 0] == j, 1], REJECT)) * 0.9 if (own[:, 0] == j).any() else 1.0 for j in range(len(centres))]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centre": [c.tolist() for c in centres], "least": least})

    rows = sorted(sample.groupBy("lang").applyInPandas(cluster, "lang string, centre array<float>, least double").collect(), key=lambda r: r.lang)
    centres = np.array([r.centre for r in rows], dtype=np.float32).reshape(len(rows), SIZE)
    return Centroids(idf, [r.lang for r in rows], centres, np.array([r.least for r in rows]))


def identified(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows:
                langs, scores, rejected = zip(*shared.value.predict(batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                                                 names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = F.col("doc_id").isNotNull() & ~learnable(F.col("doc_id"))
    return identified(docs, fit(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op7_language_id": op7_language_id}
