"""Feature pipeline: cleaned documents -> normalised text -> TF-IDF + dense features.

``build_features`` wires the operators into one lazy plan and returns the
intermediate tables, so later steps (selection, models, scoring) reuse the
same definitions.  ``fit_on`` restricts vocabulary/IDF fitting to a subset of
documents (e.g. the training split) while still transforming all of them.
"""
from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import arrow_text as at
from corpusflow.functions import text as tx
from corpusflow.operators import features as fe
from corpusflow.operators import profile as pr
from corpusflow.operators import term_blocks as tb
from corpusflow.session import ensure_checkpoint_dir, materialised


class Features:
    """The feature tables, each built when it is first asked for.

    ``docs`` doc_id, label, sample_name, description, transcription, *_cleaned;
    ``counts`` doc_id, term, tf; ``vocab`` term, df, cf, idf, feature_index;
    ``tfidf`` doc_id, term, value; ``dense`` doc_id + dense feature columns;
    ``matrix`` doc_id, feature, value (long, sparse); ``labels`` doc_id, label,
    class_id (reads no normalised text); ``n_docs`` and ``n_features`` scalars.

    Where intermediates are materialised and the vocabulary is bounded, terms are
    counted inside each document's row (``whole_rows``); the long table of all
    (doc, term) pairs, ``counts``, is then never built.
    """

    def __init__(self, docs: DataFrame, text_col: str, max_features: int | None, min_df, max_df, ngram, stop_words,
                 fit_on: DataFrame | None, mode: str, pattern: str = tx.TOKEN_PATTERN, analyzer: str = "word", keep_docs: bool = True):
        self._keep_docs = keep_docs
        self._source, self._text_col, self._mode, self._fit_on = docs, text_col, mode, fit_on
        self._max_features, self._min_df, self._max_df, self._ngram, self._stops = max_features, min_df, max_df, ngram, stop_words
        self._pattern, self._analyzer = pattern, analyzer
        self._in_rows = mode != "lazy" and bool(max_features)

    @cached_property
    def docs(self) -> DataFrame:
        return _cut(self._source, self._mode) if self._keep_docs else self._source

    @cached_property
    def term_rows(self) -> DataFrame:
        """doc_id and the array of a document's terms, repeats included."""
        return self.with_terms(self.joined)

    @cached_property
    def joined(self) -> DataFrame:
        """doc_id and the document's tokens in one string: the terms are cut from it where they are needed."""
        return _cut(fe.joined_terms(self.docs, self._text_col, "doc_id", self._stops, self._pattern, self._analyzer), self._mode)

    def with_terms(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``terms`` in place of ``j``."""
        return rows.select("doc_id", fe.ngrams_of(self._ngram, self._analyzer).alias("terms"), *[c for c in rows.columns if c not in ("doc_id", "j")])

    @cached_property
    def whole_joined(self) -> DataFrame | None:
        """``joined`` where its rows are whole documents: counted in blocks of documents."""
        return self.joined if self._in_rows and self.ngram and fe.ids_are_unique(self.joined) else None

    @property
    def ngram(self) -> tuple | None:
        """The n-grams that are counted in blocks, as ``features.block_ngram`` has them."""
        return fe.block_ngram(self._ngram, self._analyzer)

    @cached_property
    def whole_rows(self) -> DataFrame:
        """``term_rows`` with one row per doc_id: rows of an id that repeats are one document."""
        if fe.ids_are_unique(self.joined):
            return self.term_rows
        return _cut(self.term_rows.groupBy("doc_id").agg(F.flatten(F.collect_list("terms")).alias("terms")), self._mode)

    @cached_property
    def counts(self) -> DataFrame:
        return _cut(fe.term_counts(self.docs, self._text_col, "doc_id", self._ngram, self._stops, self._pattern, self._analyzer), self._mode)

    @cached_property
    def vocab(self) -> DataFrame:
        blocks = self.whole_joined
        terms, docs = blocks if blocks is not None else self.whole_rows if self._in_rows else self.counts, self.docs
        if self._fit_on is not None:
            docs = self._fit_on
            terms = terms.join(docs.select("doc_id"), "doc_id", "left_semi")
        limits = self._min_df, self._max_df, self._max_features
        if self._in_rows:
            n = docs.count()
            return _cut(fe.vocabulary_of(fe.vocabulary_stats(terms, {None: n}, *limits, ngram=self.ngram if blocks is not None else None), n, *limits), self._mode)
        return _cut(fe.vocabulary(terms, docs.select(F.count(F.lit(1))).scalar(), *limits), self._mode)

    def _long(self, counts_only: bool) -> DataFrame | None:
        """doc_id, term, value from vectors made in each row; None where the long counts are to be used."""
        vocab = self.vocab.orderBy("feature_index").collect() if self._in_rows else []  # at most max_features rows
        if not vocab:
            return None
        if self.whole_joined is not None:
            vectors = materialised(fe.blocks(self.ngram).term_vectors(self.whole_joined, vocab, self.ngram, counts_only))
        else:
            vectors = materialised(fe.term_vectors(self.whole_rows, vocab, counts_only), SPARSE)
        cell = vectors.select("doc_id", F.explode(F.arrays_zip("v.indices", "v.values")).alias("c"))
        names = F.broadcast(self.vocab.select("term", F.col("feature_index").cast("int").alias("i")))
        return cell.select("doc_id", F.col("c.indices").alias("i"), F.col("c.values").alias("value")).join(names, "i").select("doc_id", "term", "value")

    @cached_property
    def tfidf(self) -> DataFrame:
        made = self._long(counts_only=False)
        return fe.tfidf(self.counts, self.vocab) if made is None else made

    @cached_property
    def term_matrix(self) -> DataFrame:
        """doc_id, term, value with raw counts over the vocabulary."""
        made = self._long(counts_only=True)
        return fe.count_matrix(self.counts, self.vocab) if made is None else made

    @cached_property
    def dense(self) -> DataFrame:
        return fe.dense_features(self.docs, fe.label_index(self.docs, "sample_name", null_as="unknown"))

    @cached_property
    def matrix(self) -> DataFrame:
        return _cut(fe.feature_matrix(self.tfidf, self.dense), self._mode)

    @cached_property
    def labels(self) -> DataFrame:
        named = self._source.select("doc_id", "label")
        return _cut(fe.encode(named, "label", fe.label_index(named, "label"), "class_id"), self._mode)

    @cached_property
    def n_docs(self) -> Column:
        return self.docs.select(F.count(F.lit(1))).scalar()

    @cached_property
    def n_features(self) -> Column:
        return self.vocab.select(F.count(F.lit(1))).scalar() + F.lit(len(fe.LENGTH_FEATURES + fe.CATEGORY_FEATURES))


def prepare_docs(clean: DataFrame, label_col: str = "lang", data_driven: bool = True) -> DataFrame:
    """Add ``transcription_cleaned`` / ``description_cleaned`` (conservative normalisation).

    ``transcription_expanded`` is the former before its punctuation is stripped, which
    ``tx.ASCII_TOKEN`` doesn't need.
    """
    if data_driven:
        dates, phones = pr.artifact_flags(clean, has=at.has_artifact)
    else:
        dates, phones = False, False
    return clean.select(
        "doc_id", F.col(label_col).alias("label"), "sample_name", "description", "transcription",
        tx.normalize_conservative(F.col("transcription"), dates, phones).alias("transcription_cleaned"),
        at.expanded(F.col("transcription"), dates, phones).alias("transcription_expanded"),
        tx.normalize_conservative(F.col("description"), dates, phones).alias("description_cleaned"))


#: How Parquet holds a sparse vector: read so, its positions and values can be exploded.
SPARSE = {"v": tb.VECTOR}


def _cut(df: DataFrame, mode: str) -> DataFrame:
    """Materialise an intermediate: ``checkpoint`` writes it as Parquet to the session's
    checkpoint folder and cuts the lineage (downstream plans stay small and a
    lost executor does not trigger recomputation from the raw text);
    ``persist`` keeps it cached; anything else leaves it lazy."""
    if mode == "checkpoint":
        return materialised(df)
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


def build_features(docs: DataFrame, text_col: str = "transcription_cleaned", max_features: int = 5000,
                   min_df=2, max_df=0.95, ngram=(1, 2), stop_words=None,
                   fit_on: DataFrame | None = None, persist=True, pattern: str = tx.TOKEN_PATTERN, analyzer: str = "word",
                   keep_docs: bool = True) -> Features:
    """Wire the feature operators.

    ``persist`` selects how the reused intermediates (normalised documents,
    term counts, vocabulary, long matrix, labels) are materialised: ``True`` or
    ``"checkpoint"`` (default) checkpoints them into ``spark.checkpoint.dir``;
    ``"persist"`` caches them; ``False`` keeps the whole plan lazy.  Each of
    them feeds several aggregates and scalar subqueries, which would otherwise
    recompute, and re-optimise, the whole text pipeline every time.
    ``keep_docs=False`` leaves the normalised documents out: where the texts they
    come from are written already, only the token strings are made from them.
    """
    mode = "checkpoint" if persist is True else (persist or "lazy")
    if mode == "checkpoint":
        ensure_checkpoint_dir(docs.sparkSession)
    stops = fe.english_stop_words() if stop_words is None else stop_words
    return Features(docs, text_col, max_features, min_df, max_df, ngram, stops, fit_on, mode, pattern, analyzer, keep_docs)
