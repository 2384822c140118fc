"""Text features as long tables ``(doc_id, feature, value)``.

Design for scale:

* Term counts are an ``explode`` + ``groupBy(doc_id, term)`` whose map-side
  partial aggregate counts each document inside the task that read it, so
  only distinct (doc, term) pairs cross the shuffle.
* Vocabulary statistics are one ``groupBy(term)`` with map-side partial
  aggregation, so frequent terms (hot keys) are pre-summed per task.  Where the
  vocabulary is bounded, terms are first counted by hash (``vocabulary_stats``),
  and only those that may enter it are counted as strings.
* The vocabulary is cut to ``max_features`` rows by a top-k, which bounds it;
  it is then broadcast to the document side, which is never shuffled for the
  lookup.
* The only per-document shuffle is the L2 norm (a window on doc_id over the
  vocabulary terms of each document).
* Nothing is densified: implicit zeros are accounted for with ``n`` (the
  number of documents) wherever a statistic needs them.
"""
from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from corpusflow.functions import arrow_text as at
from corpusflow.functions import stopwords
from corpusflow.functions import text as tx
from corpusflow.operators import char_blocks, term_blocks
from corpusflow.session import materialised

MAX_CLASSES = 100_000
#: Counters of hashed terms: what a task sends at most, before any term is counted as a string.
BUCKETS = 1 << 20


def check_bounded(df: DataFrame, max_rows: int, what: str) -> DataFrame:
    """Fail fast when a table meant to be broadcast is larger than ``max_rows``."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; refusing to broadcast it")
    return df


def joined_terms(df: DataFrame, text_col: str, id_col: str = "doc_id", stop_words=None,
                 pattern: str = tx.TOKEN_PATTERN, analyzer: str = "word") -> DataFrame:
    """``(doc_id, j)``: the tokens of each document in one string (``char``: its text), from which n-grams are cut."""
    if analyzer == "char":
        j = tx.collapse_ws(F.col(text_col))
    elif pattern == tx.ASCII_TOKEN:
        j = at.joined_tokens(F.col(text_col), stop_words)
    else:
        j = tx.joined_tokens(F.col(text_col), pattern, stop_words)
    return df.select(F.col(id_col).alias("doc_id"), j.alias("j"))


def ngrams_of(ngram=(1, 2), analyzer: str = "word") -> Column:
    """The term array of the column ``j`` of ``joined_terms``."""
    return (tx.char_ngrams if analyzer == "char" else tx.word_ngrams_from_joined)(F.col("j"), ngram[0], ngram[1])


def block_ngram(ngram, analyzer: str = "word") -> tuple | None:
    """What ``blocks`` needs to count these n-grams in blocks of documents; None where a key of so many words would be too long."""
    return (*ngram, "char") if analyzer == "char" else tuple(ngram) if ngram[1] <= 4 else None


def blocks(ngram: tuple):
    """The module that counts n-grams in blocks of documents: of characters if ``ngram`` ends with ``char``, else of words."""
    return char_blocks if ngram[2:] else term_blocks


def ids_are_unique(docs: DataFrame, id_col: str = "doc_id") -> bool:
    """No id comes twice, so each row is a whole document; reads the ids only."""
    return docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).isEmpty()


def term_arrays(df: DataFrame, text_col: str, id_col: str = "doc_id", ngram=(1, 2),
                stop_words=None, pattern: str = tx.TOKEN_PATTERN, analyzer: str = "word") -> DataFrame:
    """``(doc_id, terms)``: the term array of each document (word or char n-grams).

    Built with native regex functions only (tokens, stop-word removal and
    n-grams), so the whole step stays in the JVM without per-element lambdas.
    """
    base = joined_terms(df, text_col, id_col, stop_words, pattern, analyzer)
    # ``j`` is its own column (used by several n-gram sizes), so the text
    # chain above it runs once per document.
    return base.select("doc_id", ngrams_of(ngram, analyzer).alias("terms"))


def term_counts(df: DataFrame, text_col: str, id_col: str = "doc_id", ngram=(1, 2),
                stop_words=None, pattern: str = tx.TOKEN_PATTERN, analyzer: str = "word") -> DataFrame:
    """``(doc_id, term, tf)``: raw term counts per document.

    ``explode`` + ``groupBy(doc_id, term)``: the map-side partial aggregate
    counts each document's terms inside the task that read it (a document is
    one row), so only distinct (doc, term) pairs are shuffled.
    """
    arrs = term_arrays(df, text_col, id_col, ngram, stop_words, pattern, analyzer)
    # explode_outer + a filter on the generated column: a plain explode makes the
    # optimizer infer ``size(terms) > 0`` and push it below the text pipeline,
    # which would run the whole regex chain a second time inside the scan.
    return (arrs.select("doc_id", F.explode_outer("terms").alias("term"))
            .filter(F.col("term").isNotNull())
            .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))


def _bucket() -> Column:
    return F.xxhash64("term").bitwiseAND(F.lit(BUCKETS - 1))


def term_stats(arrays: DataFrame, folds: tuple = (), only: DataFrame | None = None) -> DataFrame:
    """``(term, df, cf)`` of term arrays with one row per document, and ``df_j``, ``cf_j`` within each of ``folds``.

    A document's distinct terms and all its terms are exploded in the task that
    reads it and counted there by term, so no (doc, term) pair is shuffled.
    ``only`` names the hash buckets (``bucket``) whose terms are counted.
    """
    both = F.explode(F.array(F.struct(F.lit(0).alias("once"), F.col("terms").alias("t")),
                             F.struct(F.lit(1).alias("once"), F.array_distinct("terms").alias("t"))))
    fold, once, more = ["fold"] if folds else [], F.col("once"), 1 - F.col("once")
    found = (arrays.select(*fold, both.alias("e")).select(*fold, "e.once", F.explode_outer("e.t").alias("term"))
             .filter(F.col("term").isNotNull()))
    if only is not None:
        found = found.withColumn("bucket", _bucket()).join(F.broadcast(only.select("bucket")), "bucket", "left_semi")
    return (found.groupBy("term").agg(F.sum(once).alias("df"), F.sum(more).alias("cf"), *[
                F.sum(F.when(F.col("fold") == j, x).otherwise(F.lit(0))).alias(f"{name}_{j}") for j in folds for name, x in (("df", once), ("cf", more))]))


def vocabulary_stats(arrays: DataFrame, n_docs: dict, min_df=2, max_df=0.95, max_features: int = 5000,
                     ngram: tuple | None = None) -> DataFrame:
    """The rows of ``term_stats`` that the vocabularies need, written once; rarer terms are never counted as strings.

    ``n_docs`` holds the number of documents of each vocabulary: under None that of
    all rows, under a ``fold`` that of all rows but this fold's.  With ``ngram`` the
    terms are the n-grams (``block_ngram``) of the column ``j``, counted in blocks of documents.

    All terms are added up in ``BUCKETS`` hashed counters, and a counter is at least
    the corpus count of each term in it.  The terms of the fullest counters are
    counted exactly.  If ``max_features`` of them pass the document limits and are
    more frequent than any other counter, no other term can be in the vocabulary.
    If not, the terms of all counters up to the last of those are counted; with too
    few such terms, all terms.
    """
    folds = tuple(j for j in n_docs if j is not None)
    fold = ["fold"] if folds else []

    def exact(only: DataFrame | None = None) -> DataFrame:
        return materialised(blocks(ngram).term_stats(arrays, ngram, BUCKETS, folds, only) if ngram else term_stats(arrays, folds, only))

    if ngram:
        sums = materialised(blocks(ngram).bucket_sums(arrays, ngram, BUCKETS, folds))
    else:
        found = arrays.select(*fold, F.explode_outer("terms").alias("term")).filter(F.col("term").isNotNull()).select(*fold, _bucket().alias("bucket"))
        sums = materialised(found.groupBy("bucket").agg(F.count(F.lit(1)).alias("cf"), *[F.count_if(F.col("fold") == j).alias(f"cf_{j}") for j in folds]))

    def less(name: str, j) -> Column:
        return F.col(name) if j is None else F.col(name) - F.col(f"{name}_{j}")

    def least(table: DataFrame, j, most: int) -> int:
        """The ``most``-th highest corpus count; 0 if there are fewer."""
        top = table.select(less("cf", j).alias("c")).orderBy(F.desc("c")).limit(most).agg(F.count("c").alias("n"), F.min("c").alias("c")).first()
        return top.c if top.n == most else 0

    def counted(floors: dict) -> tuple[DataFrame, Column]:
        if min(floors.values()) < 2:
            return exact(), F.lit(True)
        full = reduce(Column.__or__, [less("cf", j) >= floor for j, floor in floors.items()])
        return exact(sums.filter(full)), full

    stats, full = counted({j: least(sums, j, 4 * max_features) for j in n_docs})
    rest = sums.filter(~full).agg(*[F.coalesce(F.max(less("cf", j)), F.lit(0)).alias(f"c_{j}") for j in n_docs]).first()
    floors = {j: least(stats.filter(_within(less("df", j), F.lit(n), min_df, max_df)), j, max_features) for j, n in n_docs.items()}
    # A term as frequent as the last one may come before it in the alphabet, so only a higher count is safe.
    return stats if all(floors[j] > rest[f"c_{j}"] or not rest[f"c_{j}"] for j in n_docs) else counted(floors)[0]


def _within(df: Column, n: Column, min_df, max_df) -> Column:
    """Whether a term's number of documents lies in the limits; floats are shares of ``n``."""
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(F.lit(min_df) * n)
    hi = F.lit(max_df) if isinstance(max_df, int) else F.lit(max_df) * n
    return (df >= lo) & (df <= hi)


def vocabulary(counts: DataFrame, n_docs, min_df=2, max_df=0.95, max_features: int | None = 5000,
               smooth_idf: bool = True) -> DataFrame:
    """Fitted vocabulary ``(term, df, cf, idf, feature_index)``.

    Pruning: ``df >= min_df`` and ``df <= max_df * n`` (floats are shares of
    ``n``, ints are counts), then the ``max_features`` terms of highest corpus
    count (ties by term).  ``idf = ln((1 + n) / (1 + df)) + 1`` (smoothed) and
    ``feature_index`` numbers the kept terms alphabetically.  ``n_docs`` is a
    number or a scalar Column.
    """
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    return vocabulary_of(stats, n_docs, min_df, max_df, max_features, smooth_idf)


def vocabulary_of(stats: DataFrame, n_docs, min_df=2, max_df=0.95, max_features: int | None = 5000,
                  smooth_idf: bool = True) -> DataFrame:
    """The ``vocabulary`` of terms counted already: ``(term, df, cf)``."""
    n = n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)
    kept = stats.filter(_within(F.col("df"), n, min_df, max_df))
    if max_features:
        kept = kept.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    idf = (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0 if smooth_idf
           else F.log(n / F.col("df")) + 1.0)
    # At most max_features rows: the ordering window runs on a bounded table.
    w = Window.orderBy("term")
    return kept.select("term", F.col("df").cast("long").alias("df"), F.col("cf").cast("long").alias("cf"),
                       idf.alias("idf"), (F.row_number().over(w) - 1).cast("long").alias("feature_index"))


def tfidf(counts: DataFrame, vocab: DataFrame, norm: str | None = "l2", sublinear_tf: bool = False) -> DataFrame:
    """``(doc_id, term, value)``: tf * idf over the vocabulary, L2-normalised per document."""
    tf = F.col("tf").cast("double")
    if sublinear_tf:
        tf = F.log(tf) + 1.0
    w = counts.join(F.broadcast(vocab.select("term", "idf")), "term").select(
        "doc_id", "term", (tf * F.col("idf")).alias("w"))
    if norm != "l2":
        return w.withColumnRenamed("w", "value")
    nrm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term", (F.col("w") / nrm).alias("value"))


def term_vectors(arrays: DataFrame, vocab: list[Row], counts_only: bool = False) -> DataFrame:
    """``(doc_id, v)``: TF-IDF (or raw counts) of each row's terms as a sparse vector over a collected vocabulary.

    Counted, weighted and normalised inside the row: nothing is shuffled.
    """
    stages = [CountVectorizerModel.from_vocabulary([r.term for r in vocab], inputCol="terms", outputCol="v" if counts_only else "tf")]
    if not counts_only:
        stages += [ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in vocab]), inputCol="tf", outputCol="w"),
                   Normalizer(p=2.0, inputCol="w", outputCol="v")]
    return PipelineModel(stages).transform(arrays).select("doc_id", "v")


def count_matrix(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(doc_id, term, value)`` with raw counts over the vocabulary."""
    return counts.join(F.broadcast(vocab.select("term")), "term").select(
        "doc_id", "term", F.col("tf").cast("double").alias("value"))


def top_terms_by_mean(values: DataFrame, n_docs, k: int = 10) -> DataFrame:
    """Top-k terms by mean value over all documents (zeros included)."""
    n = n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)
    return (values.groupBy("term").agg(F.sum("value").alias("s"))
            .select("term", (F.col("s") / n).alias("mean_value"))
            .orderBy(F.desc("mean_value"), F.asc("term")).limit(k))


def label_index(df: DataFrame, label_col: str, null_as: str | None = None,
                max_classes: int = MAX_CLASSES) -> DataFrame:
    """``(label, label_id)``: sorted distinct labels numbered 0..k-1 (size-checked)."""
    lab = F.coalesce(F.col(label_col), F.lit(null_as)) if null_as is not None else F.col(label_col)
    distinct = df.select(lab.alias("label")).filter(F.col("label").isNotNull()).distinct()
    check_bounded(distinct, max_classes, f"label set of {label_col}")
    return distinct.select("label", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("long").alias("label_id"))


def encode(df: DataFrame, label_col: str, index: DataFrame, out_col: str,
           null_as: str | None = None, unseen: int | None = None) -> DataFrame:
    """Attach the code of ``label_col`` (broadcast join on the bounded label index)."""
    lab = F.coalesce(F.col(label_col), F.lit(null_as)) if null_as is not None else F.col(label_col)
    idx = index.select(F.col("label").alias("__lab"), F.col("label_id").alias(out_col))
    out = df.withColumn("__lab", lab).join(F.broadcast(idx), "__lab", "left").drop("__lab")
    if unseen is not None:
        out = out.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(unseen)))
    return out


# Names of the dense per-document features, in the reference's order.
LENGTH_FEATURES = ["transcription_char_length", "transcription_word_count", "description_char_length",
                   "description_word_count", "text_length_ratio", "text_length_category"]
CATEGORY_FEATURES = ["sample_name_encoded"] + [f"has_{w}" for w in tx.SECTION_WORDS]


def dense_features(df: DataFrame, sample_index: DataFrame | None, id_col: str = "doc_id",
                   serving: bool = False) -> DataFrame:
    """Length, length-category, sample-name code and section flags per document (wide)."""
    tc, dc = tx.char_length("transcription"), tx.char_length("description")
    out = df.select(
        F.col(id_col).alias("doc_id"), "sample_name",
        tc.cast("double").alias("transcription_char_length"),
        at.word_count("transcription").cast("double").alias("transcription_word_count"),
        (F.lit(0.0) if serving else dc.cast("double")).alias("description_char_length"),
        (F.lit(0.0) if serving else at.word_count("description").cast("double")).alias("description_word_count"),
        (tc / ((F.lit(0) if serving else dc) + 1)).cast("double").alias("text_length_ratio"),
        tx.length_category_code(tc).cast("double").alias("text_length_category"),
        *[tx.section_flag("transcription", w).cast("double").alias(f"has_{w}") for w in tx.SECTION_WORDS])
    if sample_index is not None:
        out = encode(out, "sample_name", sample_index, "sample_name_encoded", null_as="unknown", unseen=0)
    else:
        out = out.withColumn("sample_name_encoded", F.lit(0))
    return out.withColumn("sample_name_encoded", F.col("sample_name_encoded").cast("double")).drop("sample_name")


def to_long(wide: DataFrame, cols: list[str], id_col: str = "doc_id", keep_zeros: bool = False) -> DataFrame:
    """Wide numeric columns to ``(doc_id, feature, value)``; zeros dropped (sparse)."""
    lng = wide.unpivot([id_col], cols, "feature", "value")
    return lng if keep_zeros else lng.filter(F.col("value") != 0)


def feature_matrix(tfidf_values: DataFrame, dense_wide: DataFrame) -> DataFrame:
    """TF-IDF terms (prefixed ``tfidf_``) plus the dense features, as one long table."""
    t = tfidf_values.select("doc_id", F.concat(F.lit("tfidf_"), F.col("term")).alias("feature"), "value")
    d = to_long(dense_wide, LENGTH_FEATURES + CATEGORY_FEATURES)
    return t.unionByName(d)


def feature_dictionary(matrix: DataFrame) -> DataFrame:
    """``(feature, kind)`` with kind tfidf / length / category."""
    f = matrix.select("feature").distinct()
    kind = (F.when(F.col("feature").startswith("tfidf_"), F.lit("tfidf"))
            .when(F.col("feature").isin(LENGTH_FEATURES), F.lit("length")).otherwise(F.lit("category")))
    return f.select("feature", kind.alias("kind"))


def minmax_stats(matrix: DataFrame, n_docs) -> DataFrame:
    """Per feature min / max with implicit zeros (a feature missing from a doc is 0)."""
    n = n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)
    s = matrix.groupBy("feature").agg(F.count(F.lit(1)).alias("nnz"), F.min("value").alias("mn"),
                                      F.max("value").alias("mx"))
    has_zero = F.col("nnz") < n
    return s.select("feature",
                    F.when(has_zero, F.least(F.col("mn"), F.lit(0.0))).otherwise(F.col("mn")).alias("min"),
                    F.when(has_zero, F.greatest(F.col("mx"), F.lit(0.0))).otherwise(F.col("mx")).alias("max"))


def minmax_scale(matrix: DataFrame, stats: DataFrame) -> DataFrame:
    """``(x - min) / (max - min)`` per feature (constant feature -> x - min).

    Stats are one row per feature: bounded by the vocabulary size plus the
    dense features, so they are broadcast.
    """
    rng = F.col("max") - F.col("min")
    out = matrix.join(F.broadcast(stats), "feature").select(
        "doc_id", "feature",
        ((F.col("value") - F.col("min")) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)).alias("value"))
    return out.filter(F.col("value") != 0)


def standard_scale(wide: DataFrame, cols: list[str], id_col: str = "doc_id") -> DataFrame:
    """``(x - mean) / std_pop`` per column on dense features (std 0 -> 1)."""
    stats = wide.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    st = stats.select(F.struct("*")).scalar()
    return wide.select(id_col, *[
        ((F.col(c) - st[f"m_{c}"]) / F.when(st[f"s_{c}"] == 0, F.lit(1.0)).otherwise(st[f"s_{c}"])).alias(c)
        for c in cols])


def matrix_stats(matrix: DataFrame, n_docs, n_features) -> DataFrame:
    """Sparsity / density %, min, max and mean over all n x d cells."""
    n = n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)
    d = n_features if not isinstance(n_features, (int, float)) else F.lit(n_features)
    cells = n * d
    s = matrix.agg(F.count(F.lit(1)).alias("nnz"), F.sum("value").alias("s"),
                   F.min("value").alias("mn"), F.max("value").alias("mx"))
    return s.select(
        n.cast("long").alias("n_docs"), d.cast("long").alias("n_features"), F.col("nnz"),
        (F.lit(100.0) * (F.lit(1.0) - F.col("nnz") / cells)).alias("sparsity_pct"),
        (F.lit(100.0) * F.col("nnz") / cells).alias("density_pct"),
        F.when(F.col("nnz") < cells, F.least("mn", F.lit(0.0))).otherwise(F.col("mn")).alias("min"),
        F.when(F.col("nnz") < cells, F.greatest("mx", F.lit(0.0))).otherwise(F.col("mx")).alias("max"),
        (F.col("s") / cells).alias("mean"))


def english_stop_words() -> tuple[str, ...]:
    return stopwords.english()
