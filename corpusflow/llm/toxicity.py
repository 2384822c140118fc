"""Toxicity: class-conditional Kneser-Ney models.

Two models of words as characters (``kneser_ney``) are learnt from labelled
documents, one per class.  A document's evidence is the highest mean log ratio
of both likelihoods over ``WINDOW`` words in a row: a mean over few words does not
fade in a long text.  A logistic curve, fitted on labelled documents that the
models have not seen and weighted to the classes' true shares, turns it into a
score.

What is bounded: the models are fitted on at most about ``MAX_ROWS`` labelled
documents per class, drawn by hash, and hold every n-gram of them.  That is what
is broadcast.  Every text is scored whole.

Defined cases: a null or empty text, or one without a letter or digit, has
evidence 0; labels of a doc_id that disagree count as toxic, null labels are
left out; if a class has no labelled document, every score is the toxic share
of the labels (0 without any); repeated rows get the same score; a null doc_id
is scored, never learnt from and not held out; an empty table gives an empty
result; only doc_id and text are read.
"""
from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusflow.llm.common import beside, read, ship_package, stored
from corpusflow.llm.kneser_ney import ORDER, ClassModels, grams

WINDOW, MAX_ROWS, THRESHOLD, MAX_WORDS = 4, 4_000, 0.7, 200_000
EDGES = ".,;:!?#*$%&|<>\"'()[]{}=+~^`_/\\-"


def clean_word(word: bytes) -> str:
    return word.decode().lower().strip(EDGES)


class WordRatios(dict):
    """Word (UTF-8 bytes) -> log ratio; NaN for a word of symbols alone."""

    def __init__(self, models: ClassModels):
        self.models, self.clean = models, {}

    def __missing__(self, word: bytes) -> float:
        key = clean_word(word)
        found = self.clean.get(key)
        if found is None:
            found = self.clean[key] = self.models.log_ratio(key) if any(map(str.isalnum, key)) else math.nan
        self[word] = found
        return found

    def evidence(self, text: str | None, window: int = WINDOW) -> float:
        if len(self) > MAX_WORDS:
            self.clear()
        if len(self.clean) > MAX_WORDS:
            self.clean.clear()
        words = (text or "").encode().split()
        ratios = np.fromiter(map(self.__getitem__, words), dtype=np.float64, count=len(words))
        ratios = ratios[~np.isnan(ratios)]
        if len(ratios) <= window:
            return float(ratios.sum()) / window
        total = np.concatenate([[0.0], np.cumsum(ratios)])
        return float((total[window:] - total[:-window]).max()) / window


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Slope and intercept by damped Newton steps; the ridge keeps separable data finite."""
    middle, spread = x.mean(), x.std() or 1.0
    design = np.stack([(x - middle) / spread, np.ones_like(x)], 1)

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * w[0] ** 2)

    w = np.array([0.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        gradient = design.T @ (weight * (p - y)) + np.array([ridge * w[0], 0.0])
        hessian = design.T @ (design * (weight * p * (1 - p))[:, None]) + np.diag([ridge, 1e-9])
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1] - w[0] * middle / spread)


class Toxicity:
    """The fitted models and curve; ``models`` is None if a class had no documents."""

    def __init__(self, models: ClassModels | None, slope: float, base: float, share: float):
        self.models, self.slope, self.base, self.share = models, slope, base, share
        self.words: WordRatios | None = None

    def __getstate__(self):
        return {**self.__dict__, "words": None}

    def evidence(self, text: str | None) -> float:
        if self.words is None:
            self.words = WordRatios(self.models)
        return self.words.evidence(text)

    def score(self, text: str | None) -> float:
        if self.models is None:
            return self.share
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * self.evidence(text) + self.base))))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def gram_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, toxic, ordinary) over the words of the sample's texts."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: tuple[Counter, Counter] = (Counter(), Counter())

        def counted() -> Iterator[pa.RecordBatch]:
            rows: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for c in (0, 1):
                for word, n in words[c].items():
                    if any(map(str.isalnum, key := clean_word(word))):
                        for gram in grams(key, order):
                            rows[gram][c] += n
                words[c].clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(rows)), *[pa.array([r[c] for r in rows.values()], pa.int64()) for c in (0, 1)]],
                                                 names=["gram", "toxic", "ordinary"])

        for batch in found:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words[0 if toxic else 1].update((text.as_py() or "").encode().split())
                if len(words[0]) + len(words[1]) > 200_000:
                    yield from counted()
        yield from counted()

    counts = sample.select("text", "toxic").mapInArrow(run, "gram string, toxic long, ordinary long")
    return counts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Toxicity:
    """Learn from the labelled documents that are not held out."""
    spark = docs.sparkSession
    ship_package(spark)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = stored(known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")), "labels")
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = sizes.get(True, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Toxicity(None, 0.0, 0.0, share)
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    rate = F.when(F.col("toxic"), max_rows / sizes[True]).otherwise(max_rows / sizes[False])
    drawn = known.where(draw < rate).select(F.col("doc_id").alias("__id"), "toxic", (F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(4)) == 0).alias("check"))
    # Bounded: about 2 * max_rows rows of 17 bytes.
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("__id")).select("text", "toxic", "check"), "sample")
    table = gram_counts(sample.where("NOT check")).toArrow()
    rows = {g: (t, o) for g, t, o in zip(*[c.to_pylist() for c in table.columns])}
    if not rows:
        return Toxicity(None, 0.0, 0.0, share)
    models = ClassModels(rows)
    found = evidence_of(sample.where("check"), Toxicity(models, 1.0, 0.0, share)).collect()
    x, y = np.array([r.evidence for r in found]), np.array([float(r.toxic) for r in found])
    if len(set(y)) < 2:
        return Toxicity(models, 1.0, -3.0, share)
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (len(y) - y.sum())) * len(y)
    return Toxicity(models, *logistic(x, y, weight), share)


def evidence_of(rows: DataFrame, model: Toxicity) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            yield pa.RecordBatch.from_arrays([pa.array([shared.value.evidence(t.as_py()) for t in batch.column(0)], pa.float64()), batch.column(1)],
                                             names=["evidence", "toxic"])

    return rows.select("text", "toxic").mapInArrow(run, "evidence double, toxic boolean")


def scored(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``docs`` with ``__score``; every column is carried."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            score = pa.array([shared.value.score(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "__score"])
        shared.value.words = None  # the worker goes on to other tasks

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__score", DoubleType())]))


@beside
def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    return scored(docs, fit(docs, labels)).where(F.col("__score") < threshold).drop("__score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, fit(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                      F.when(F.col("__score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
