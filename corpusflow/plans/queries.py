"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

They run the library operators over the whole input tables (or data Spark
derives from them).  ``corpusflow.plans.oracle`` holds the DuckDB twin of each
SQL-checkable one under the same key.
"""
from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import arrow_text as at
from corpusflow.functions import text as tx
from corpusflow.operators import clean as cl
from corpusflow.operators import profile as pr
from corpusflow.sources.tables import documents, labelled_documents, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _raw(spark, sf, **kw):
    return labelled_documents(spark, sf, **kw)


def _clean(spark, sf, **kw):
    return cl.clean_pipeline(_raw(spark, sf), **kw)


# --- sources / inspection -------------------------------------------------

@query("table_profile")
def q_table_profile(spark, sf):
    return pr.table_profile(documents(spark, sf))


# --- projections / filters ------------------------------------------------

@query("clean_missing")
def q_clean_missing(spark, sf):
    return cl.clean_missing(_raw(spark, sf)).select("doc_id", "description", "medical_specialty",
                                                    "sample_name", "transcription")


@query("filter_short")
def q_filter_short(spark, sf):
    return cl.filter_short(_raw(spark, sf)).select("doc_id", F.length("transcription").alias("chars"))


@query("outlier_cap")
def q_outlier_cap(spark, sf):
    out = cl.handle_outliers(_raw(spark, sf), method="cap")
    return out.select("doc_id", F.length("transcription").alias("chars"),
                      tx.sha256_prefix(F.col("transcription")).alias("text_hash"))


@query("outlier_remove")
def q_outlier_remove(spark, sf):
    out = cl.handle_outliers(_raw(spark, sf), method="remove")
    return out.select("doc_id", F.length("transcription").alias("chars"))


@query("valid_text")
def q_valid_text(spark, sf):
    conv = read_table(spark, sf, "conversations")
    valid, rejected = cl.valid_text(conv, "text")
    return valid.select("conv_id", "turn", F.length("text").alias("chars")).unionByName(
        rejected.select("conv_id", "turn", F.lit(-1).alias("chars")))


@query("coerce_numeric")
def q_coerce_numeric(spark, sf):
    ev = read_table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type")
    return cl.coerce_numeric(ev, ["k", "event_type"])


# --- scalar text functions ---------------------------------------------------

@query("clean_text")
def q_clean_text(spark, sf):
    d = documents(spark, sf)
    c = tx.clean_text(F.col("text"))
    return d.select("doc_id", F.length(c).alias("chars"), tx.sha256_prefix(c).alias("text_hash"))


@query("clean_text_effect")
def q_clean_text_effect(spark, sf):
    return cl.clean_text_effect(_raw(spark, sf))


# --- profiling ---------------------------------------------------------------

@query("class_top_n")
def q_class_top_n(spark, sf):
    return pr.class_top_n(_raw(spark, sf), "lang", 10).unionByName(
        pr.class_top_n(_raw(spark, sf), "medical_specialty", 10))


@query("null_profile")
def q_null_profile(spark, sf):
    return pr.null_profile(_raw(spark, sf, keywords=True))


@query("duplicate_rows")
def q_duplicate_rows(spark, sf):
    return pr.duplicate_rows(documents(spark, sf), ["text", "lang", "source"])


@query("class_tiers")
def q_class_tiers(spark, sf):
    return pr.class_tiers(_raw(spark, sf), "medical_specialty", (100, 20, 5))


@query("text_length_stats")
def q_text_length_stats(spark, sf):
    return pr.text_length_stats(_raw(spark, sf))


@query("iqr_outliers")
def q_iqr_outliers(spark, sf):
    return pr.iqr_outliers(_raw(spark, sf))


@query("text_extremes")
def q_text_extremes(spark, sf):
    return pr.text_extremes(_raw(spark, sf), "transcription", "medical_specialty")


@query("text_quality")
def q_text_quality(spark, sf):
    return pr.text_quality(_raw(spark, sf))


@query("section_counts")
def q_section_counts(spark, sf):
    return pr.section_counts(_raw(spark, sf))


@query("vocab_richness")
def q_vocab_richness(spark, sf):
    return pr.vocab_richness(_clean(spark, sf), "transcription", "medical_specialty", 5)


@query("vocab_overlap")
def q_vocab_overlap(spark, sf):
    return pr.vocab_overlap(_clean(spark, sf), "transcription", "lang")


@query("class_top_terms")
def q_class_top_terms(spark, sf):
    return pr.class_top_terms(_clean(spark, sf), "transcription", "medical_specialty", 5, 10)


@query("feature_availability")
def q_feature_availability(spark, sf):
    return pr.feature_availability(_raw(spark, sf, keywords=True))


@query("eda_summary")
def q_eda_summary(spark, sf):
    return pr.eda_summary(_raw(spark, sf), "transcription", "lang", 100)


@query("data_quality_gate")
def q_data_quality_gate(spark, sf):
    return pr.data_quality_gate(_raw(spark, sf), "transcription", "medical_specialty")


@query("reduce_classes")
def q_reduce_classes(spark, sf):
    red = cl.reduce_classes(cl.filter_short(_raw(spark, sf)), "medical_specialty", 15)
    return cl.class_distribution(red, "medical_specialty")


@query("clean_pipeline")
def q_clean_pipeline(spark, sf):
    return _clean(spark, sf, outlier_method="cap").select(
        "doc_id", "medical_specialty", F.length("transcription").alias("chars"),
        tx.sha256_prefix(F.col("transcription")).alias("text_hash"))


@query("clean_summary")
def q_clean_summary(spark, sf):
    return cl.clean_summary(_raw(spark, sf), _clean(spark, sf, outlier_method="cap"))


# --- text normalisation and features of single texts -------------------------

def _norm_out(df, c, id_col="doc_id"):
    return df.select(id_col, F.length(c).alias("chars"), tx.sha256_prefix(c).alias("text_hash"))


@query("normalize_conservative")
def q_normalize_conservative(spark, sf):
    d = _clean(spark, sf)
    dates, phones = pr.artifact_switches(d)
    return _norm_out(d, tx.normalize_conservative(F.col("transcription"), dates, phones))


@query("normalize_aggressive")
def q_normalize_aggressive(spark, sf):
    d = _clean(spark, sf)
    return _norm_out(d, tx.normalize_aggressive(F.col("transcription")))


@query("strip_punct")
def q_strip_punct(spark, sf):
    p = read_table(spark, sf, "pages")
    c = tx.strip_punct(tx.clean_text(F.lower(F.col("html"))))
    return _norm_out(p, c, "page_id")


@query("normalize_simple")
def q_normalize_simple(spark, sf):
    d = _clean(spark, sf)
    return _norm_out(d, tx.normalize_simple(F.col("transcription")))


@query("artifact_scan")
def q_artifact_scan(spark, sf):
    d = _clean(spark, sf).select(F.lit("documents").alias("src"), "doc_id", "transcription")
    p = read_table(spark, sf, "pages").select(F.lit("pages").alias("src"), F.col("page_id").alias("doc_id"),
                                              tx.clean_text(F.col("html")).alias("transcription"))
    return (pr.artifact_scan(d).select(F.lit("documents").alias("src"), "*")
            .unionByName(pr.artifact_scan(p).select(F.lit("pages").alias("src"), "*")))


@query("artifact_examples")
def q_artifact_examples(spark, sf):
    """Up to five examples of each artifact pattern in the pages."""
    p = read_table(spark, sf, "pages").select(tx.clean_text(F.col("html")).alias("transcription"))
    return pr.artifact_examples(p)


@query("combined_text")
def q_combined_text(spark, sf):
    d = _clean(spark, sf)
    c = tx.combined_text(tx.normalize_conservative(F.col("description")),
                         tx.normalize_conservative(F.col("transcription")))
    return _norm_out(d, c)


@query("length_features")
def q_length_features(spark, sf):
    d = _clean(spark, sf)
    return d.select(
        "doc_id",
        tx.char_length("transcription").alias("transcription_char_length"),
        tx.word_count("transcription").alias("transcription_word_count"),
        tx.char_length("description").alias("description_char_length"),
        tx.word_count("description").alias("description_word_count"),
        F.round(tx.char_length("transcription") / (tx.char_length("description") + 1), 6)
        .alias("text_length_ratio"))


@query("length_category")
def q_length_category(spark, sf):
    d = documents(spark, sf)
    return d.select("doc_id", tx.length_category_label(F.length("text")).alias("text_length_category"),
                    tx.length_category_code(F.length("text")).alias("text_length_code"))


@query("section_flags")
def q_section_flags(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", *[tx.section_flag(F.col("html"), w).alias(f"has_{w}")
                                 for w in tx.SECTION_WORDS])


@query("input_hash")
def q_input_hash(spark, sf):
    d = documents(spark, sf)
    return d.select("doc_id", tx.sha256_prefix(F.col("text")).alias("input_hash"),
                    F.length(F.substring("text", 1, 500)).alias("input_length"))


@query("request_id")
def q_request_id(spark, sf):
    ev = read_table(spark, sf, "events")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return ev.select("event_id", tx.request_id(ts, F.col("props")).alias("request_id"))


@query("text_stats")
def q_text_stats(spark, sf):
    c = read_table(spark, sf, "conversations")
    s = c.select("conv_id", "turn", tx.text_stats(F.col("text")).alias("s"))
    return s.select("conv_id", "turn", "s.text_length", "s.word_count",
                    *[F.round(f"s.{k}", 6).alias(k) for k in
                      ("avg_word_length", "char_diversity", "uppercase_ratio", "digit_ratio",
                       "punctuation_ratio")])


@query("vector_stats")
def q_vector_stats(spark, sf):
    from corpusflow.functions.stats import vector_stats
    e = read_table(spark, sf, "embeddings")
    s = e.select("vec_id", vector_stats(F.col("embedding")).alias("s"))
    return s.select("vec_id", F.round("s.mean", 6).alias("mean"), F.round("s.std", 6).alias("std"),
                    F.col("s.min").alias("min"), F.col("s.max").alias("max"),
                    F.round("s.zero_fraction", 6).alias("zero_fraction"))


# --- monitoring ----------------------------------------------------------------

from corpusflow.operators import monitor as mon  # noqa: E402
from corpusflow.sources import logs  # noqa: E402

MODEL_LOADED_AT = "2024-01-23 00:00:00"


def _req(spark, sf):
    return logs.request_log(read_table(spark, sf, "events"))


def _pred(spark, sf):
    return logs.prediction_log(read_table(spark, sf, "events"))


@query("log_parse")
def q_log_parse(spark, sf):
    ev = read_table(spark, sf, "events")
    lines = ev.select("event_id", F.to_json(F.struct(
        F.lit("INFO").alias("level"), F.lit("requests").alias("logger"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
                 F.lit("/predict").alias("endpoint"), F.lit("POST").alias("method"),
                 F.get_json_object("props", "$.k").cast("int").alias("status_code"),
                 F.col("value").alias("response_time_ms")).alias("message"))).alias("value"))
    good, bad = logs.parse_json_log(lines, logs.REQUEST_SCHEMA, envelope=True)
    good = logs.with_event_time(good)
    return good.groupBy(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("response_time_ms"), 6).alias("sum_rt"),
        F.sum("status_code").cast("long").alias("sum_k"))


@query("log_rejects")
def q_log_rejects(spark, sf):
    """Log lines that parse and those that do not; every thirteenth line is cut off."""
    ev = read_table(spark, sf, "events")
    line = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.lit("/predict").alias("endpoint"),
                              F.col("value").alias("response_time_ms")))
    lines = ev.select(F.when(F.col("event_id") % 13 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    good, bad = logs.parse_json_log(lines, logs.REQUEST_SCHEMA)
    return good.groupBy(F.lit("parsed").alias("outcome")).agg(F.count(F.lit(1)).alias("n")).unionByName(
        bad.groupBy(F.lit("rejected").alias("outcome")).agg(F.count(F.lit(1)).alias("n")))


@query("slow_requests")
def q_slow_requests(spark, sf):
    return mon.slow_requests(_req(spark, sf), 400).select("event_id", "endpoint", "response_time_ms")


@query("low_confidence")
def q_low_confidence(spark, sf):
    return mon.low_confidence(_pred(spark, sf)).select("seq", "prediction", F.round("confidence", 6).alias("confidence"))


def _error_lines(spark, sf):
    """The events as lines of the structured log: errors are failed predictions, every fifth a warning."""
    ev = read_table(spark, sf, "events")
    level = F.when(F.col("event_type") != "error", F.lit("INFO")).when(F.col("event_id") % 5 == 0, F.lit("WARNING")).otherwise(F.lit("ERROR"))
    record = F.struct(F.when(F.col("event_type") == "error", F.lit("prediction_error")).otherwise(F.lit("prediction")).alias("event_type"),
                      F.col("event_id").cast("string").alias("request_id"), F.lit("v1").alias("model_version"))
    return ev.select(F.to_json(F.struct(level.alias("level"), record.alias("message"))).alias("value"))


def _prediction_errors(spark, sf):
    kind = f"struct<level:string,message:{logs.ERROR_SCHEMA.simpleString()}>"
    log = _error_lines(spark, sf).select(F.from_json("value", kind).alias("r")).select("r.level", "r.message.*")
    return mon.prediction_errors(log)


@query("prediction_errors")
def q_prediction_errors(spark, sf):
    """Failed predictions, parsed from the lines of the structured log."""
    return _prediction_errors(spark, sf).select(F.col("request_id").cast("long").alias("event_id"), "model_version", "event_type")


@query("log_counters")
def q_log_counters(spark, sf):
    """Counters by status, endpoint, version, failures and low confidence."""
    return mon.log_counters(_req(spark, sf), _pred(spark, sf))


@query("rolling_kpis")
def q_rolling_kpis(spark, sf):
    return mon.rolling_kpis(_req(spark, sf), 60)


@query("floor_percentile")
def q_floor_percentile(spark, sf):
    from corpusflow.functions.stats import floor_percentiles
    return floor_percentiles(_req(spark, sf), ["endpoint"], "response_time_ms",
                             {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("endpoint_metrics")
def q_endpoint_metrics(spark, sf):
    return mon.endpoint_metrics(_req(spark, sf))


@query("error_summary")
def q_error_summary(spark, sf):
    return mon.error_summary(_req(spark, sf), 24)


@query("recent_errors")
def q_recent_errors(spark, sf):
    return mon.recent_errors(_req(spark, sf), 10)


@query("hourly_trends")
def q_hourly_trends(spark, sf):
    return mon.hourly_trends(_req(spark, sf), 24)


@query("anomalies")
def q_anomalies(spark, sf):
    return mon.anomalies(mon.rolling_kpis(_req(spark, sf), 60))


@query("metrics_export")
def q_metrics_export(spark, sf):
    return mon.metrics_export(mon.rolling_kpis(_req(spark, sf), 60)).select(
        "metric", F.round("value", 6).alias("value"))


@query("prediction_perf")
def q_prediction_perf(spark, sf):
    return mon.prediction_perf(_pred(spark, sf), errors=_prediction_errors(spark, sf))


@query("drift_report")
def q_drift_report(spark, sf):
    return mon.drift_report(_pred(spark, sf), 100)


@query("drift_distribution")
def q_drift_distribution(spark, sf):
    return mon.drift_distribution(_pred(spark, sf), 100)


@query("staleness")
def q_staleness(spark, sf):
    kpis = mon.rolling_kpis(_req(spark, sf), 60)
    return mon.staleness(kpis, _pred(spark, sf), MODEL_LOADED_AT)


@query("usage_by_client")
def q_usage_by_client(spark, sf):
    return mon.usage_by_client(_req(spark, sf))


@query("latency_histogram")
def q_latency_histogram(spark, sf):
    return mon.latency_histogram(_req(spark, sf)).select(
        "bucket", F.round("lower_ms", 6).alias("lower_ms"), "n")


@query("alert_windows")
def q_alert_windows(spark, sf):
    return mon.alert_windows(_req(spark, sf), error_count=5, p95_ms=450.0, quiet_minutes=10)


@query("dashboard_series")
def q_dashboard_series(spark, sf):
    return mon.dashboard_series(_req(spark, sf), _pred(spark, sf))


# --- features ------------------------------------------------------------------

from corpusflow.operators import features as fe  # noqa: E402
from corpusflow.plans import pipeline as pl  # noqa: E402
from corpusflow.session import materialised  # noqa: E402


def _docs(spark, sf):
    return pl.prepare_docs(_clean(spark, sf))


def _features(spark, sf, **kw):
    """The cleaned texts are read by both artifact switches, the labels and the normalised texts: written once."""
    docs = pl.prepare_docs(materialised(_clean(spark, sf, clean=at.clean_text)))
    return pl.build_features(docs, "transcription_expanded", pattern=tx.ASCII_TOKEN, keep_docs=False, **kw)


def _per_doc(spark, sf, docs, text_col, **kw):
    """Distinct and all terms of each document that has any; counted in its row, unless ids repeat."""
    if fe.ids_are_unique(documents(spark, sf)):
        terms = fe.term_arrays(docs, text_col, **kw)
        sizes = F.struct(F.size(F.array_distinct("terms")).cast("long").alias("n_terms"), F.size("terms").cast("long").alias("n_tokens"))
        # The filter is on a generated column: pushed below the text pipeline, it would run every regex again.
        return terms.select("doc_id", F.explode_outer(F.array(sizes)).alias("s")).filter(F.col("s.n_tokens") > 0).select("doc_id", "s.*")
    return fe.term_counts(docs, text_col, **kw).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"),
                                                                      F.sum("tf").cast("long").alias("n_tokens"))


@query("tokens")
def q_tokens(spark, sf):
    return _per_doc(spark, sf, _docs(spark, sf), "transcription_cleaned", ngram=(1, 1))


@query("ngrams_1_2")
def q_ngrams_1_2(spark, sf):
    return _per_doc(spark, sf, _docs(spark, sf), "transcription_cleaned", ngram=(1, 2), stop_words=fe.english_stop_words())


def _variant_docs(spark, sf):
    d = _clean(spark, sf, clean=at.clean_text)
    return d.select("doc_id", tx.normalize_simple(F.col("transcription")).alias("t"))


@query("ngrams_1_3")
def q_ngrams_1_3(spark, sf):
    return _per_doc(spark, sf, _variant_docs(spark, sf), "t", ngram=(1, 3),
                    stop_words=fe.english_stop_words(), pattern=tx.DEFAULT_TOKEN_PATTERN)


@query("vocabulary")
def q_vocabulary(spark, sf):
    f = _features(spark, sf)
    return f.vocab.select("term", "df", "cf", F.round("idf", 6).alias("idf"), "feature_index")


@query("tfidf")
def q_tfidf(spark, sf):
    f = _features(spark, sf)
    return f.tfidf.select("doc_id", "term", F.round("value", 6).alias("value"))


@query("tfidf_top_terms")
def q_tfidf_top_terms(spark, sf):
    f = _features(spark, sf)
    return fe.top_terms_by_mean(f.tfidf, f.n_docs, 10).select("term", F.round("mean_value", 6).alias("mean_value"))


def _variant_features(spark, sf, ngram, min_df, max_df, max_features, analyzer="word"):
    return pl.build_features(_variant_docs(spark, sf), "t", max_features, min_df, max_df, ngram,
                             pattern=tx.DEFAULT_TOKEN_PATTERN, analyzer=analyzer)


def _matrix_summary(values):
    return values.groupBy("doc_id").agg(F.count(F.lit(1)).alias("nnz"),
                                        F.round(F.sum("value"), 6).alias("total"))


@query("count_features")
def q_count_features(spark, sf):
    return _matrix_summary(_variant_features(spark, sf, (1, 2), 2, 0.95, 2000).term_matrix)


@query("char_ngrams")
def q_char_ngrams(spark, sf):
    return _matrix_summary(_variant_features(spark, sf, (3, 5), 2, 0.95, 1500, analyzer="char").tfidf)


@query("label_encode")
def q_label_encode(spark, sf):
    return fe.label_index(_clean(spark, sf), "medical_specialty")


@query("category_encode")
def q_category_encode(spark, sf):
    d = _raw(spark, sf)
    idx = fe.label_index(d, "sample_name", null_as="unknown")
    return fe.encode(d.select("doc_id", "sample_name"), "sample_name", idx, "sample_name_encoded",
                     null_as="unknown", unseen=0).select("doc_id", "sample_name_encoded")


def _feature_summary(matrix):
    return matrix.groupBy("feature").agg(F.count(F.lit(1)).alias("nnz"),
                                         F.round(F.sum("value"), 6).alias("total"))


@query("feature_matrix")
def q_feature_matrix(spark, sf):
    return _feature_summary(_features(spark, sf).matrix)


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    f = _features(spark, sf)
    st = fe.minmax_stats(f.matrix, f.n_docs)
    return _feature_summary(fe.minmax_scale(f.matrix, st))


@query("standard_scale")
def q_standard_scale(spark, sf):
    f = _features(spark, sf)
    cols = fe.LENGTH_FEATURES
    s = fe.standard_scale(f.dense.select("doc_id", *cols), cols)
    return s.select("doc_id", *[F.round(c, 6).alias(c) for c in cols])


@query("matrix_stats")
def q_matrix_stats(spark, sf):
    f = _features(spark, sf)
    s = fe.matrix_stats(f.matrix, f.n_docs, f.n_features)
    return s.select("n_docs", "n_features", "nnz", *[F.round(c, 6).alias(c) for c in
                                                     ("sparsity_pct", "density_pct", "min", "max", "mean")])


@query("transform_new")
def q_transform_new(spark, sf):
    f = _features(spark, sf)
    bench = read_table(spark, sf, "benchmark")
    new = bench.select(F.col("item_id").alias("doc_id"), F.lit(None).cast("string").alias("sample_name"),
                       F.lit(None).cast("string").alias("description"),
                       tx.clean_text(F.col("text")).alias("transcription"))
    new = new.withColumn("transcription_cleaned", tx.normalize_conservative(F.col("transcription")))
    counts = fe.term_counts(new, "transcription_cleaned", ngram=(1, 2), stop_words=fe.english_stop_words())
    t = fe.tfidf(counts, f.vocab)
    sample_index = fe.label_index(f.docs, "sample_name", null_as="unknown")
    dense = fe.dense_features(new, sample_index, serving=True)
    return _matrix_summary(fe.feature_matrix(t, dense))


@query("feature_pipeline")
def q_feature_pipeline(spark, sf):
    f = _features(spark, sf)
    return _matrix_summary(f.matrix)


# --- feature analysis and selection ----------------------------------------------

from corpusflow.operators import models as md  # noqa: E402
from corpusflow.operators import selection as se  # noqa: E402


def _r6(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("feature_variance")
def q_feature_variance(spark, sf):
    f = _features(spark, sf)
    return se.variance_report(se.feature_variance(f.matrix, f.n_docs))


@query("drop_constant_features")
def q_drop_constant_features(spark, sf):
    f = _features(spark, sf)
    kept = se.drop_constant_features(f.matrix, f.n_docs)
    return kept.groupBy("feature").agg(F.count(F.lit(1)).alias("nnz"))


@query("f_score")
def q_f_score(spark, sf):
    f = _features(spark, sf)
    return _r6(se.f_score(f.matrix, f.labels), ["score"])


@query("chi2_score")
def q_chi2_score(spark, sf):
    f = _features(spark, sf)
    return _r6(se.chi2_score(f.matrix, f.labels), ["score"])


@query("mutual_info")
def q_mutual_info(spark, sf):
    f = _features(spark, sf)
    return _r6(se.mutual_info(f.matrix, f.labels), ["score"])


@query("select_k_best")
def q_select_k_best(spark, sf):
    f = _features(spark, sf)
    return _r6(se.select_k_best(se.f_score(f.matrix, f.labels), 500), ["score"])


@query("selector_overlap")
def q_selector_overlap(spark, sf):
    f = _features(spark, sf)
    return se.selector_overlap(se.f_score(f.matrix, f.labels), se.mutual_info(f.matrix, f.labels), 100)


@query("dimensionality")
def q_dimensionality(spark, sf):
    f = _features(spark, sf)
    k = f.labels.select(F.countDistinct("class_id")).scalar()
    return se.dimensionality(f.n_docs, f.n_features, k, spark)


@query("model_advice")
def q_model_advice(spark, sf):
    f = _features(spark, sf)
    k = f.labels.select(F.countDistinct("class_id")).scalar()
    dims = se.dimensionality(f.n_docs, f.n_features, k, spark)
    return se.model_advice(dims, fe.matrix_stats(f.matrix, f.n_docs, f.n_features))


@query("selection_advice")
def q_selection_advice(spark, sf):
    f = _features(spark, sf)
    return se.selection_advice(se.feature_variance(f.matrix, f.n_docs), f.n_features, sp.pair_summary(_correlations(f)))


# --- models ------------------------------------------------------------------------

@query("split_holdout")
def q_split_holdout(spark, sf):
    f = _features(spark, sf)
    return md.split_holdout(f.labels)


@query("kfold_assign")
def q_kfold_assign(spark, sf):
    f = _features(spark, sf)
    return md.kfold_assign(f.labels, 3)


def _nb_holdout(spark, sf, complement=False, alpha=1.0):
    f = _features(spark, sf)
    # One row per document, reused by training, scoring and every scalar: persisted.
    split = md.split_holdout(f.labels).persist(StorageLevel.MEMORY_AND_DISK)
    train = split.filter(~F.col("is_test")).select("doc_id", "class_id")
    test = split.filter(F.col("is_test")).select("doc_id", "class_id")
    model = md.nb_fit(f.matrix.join(train, "doc_id", "left_semi"), train, alpha=alpha,
                      complement=complement, n_features=f.n_features)
    pred = md.nb_predict(model, f.matrix.join(test, "doc_id", "left_semi"), test)
    return f, model, pred.join(test, "doc_id").persist(StorageLevel.MEMORY_AND_DISK)


@query("nb_train")
def q_nb_train(spark, sf):
    _, model, _ = _nb_holdout(spark, sf)
    per = model.deltas.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_deltas"),
                                               F.sum("delta").alias("sum_delta"))
    out = model.classes.join(per, "class_id", "left")
    return _r6(out, ["base", "slope", "sum_delta"])


@query("nb_predict")
def q_nb_predict(spark, sf):
    _, _, pred = _nb_holdout(spark, sf)
    return _r6(pred.select("doc_id", "class_id", "pred_class_id", "confidence"), ["confidence"])


@query("complement_nb")
def q_complement_nb(spark, sf):
    _, _, pred = _nb_holdout(spark, sf, complement=True)
    return _r6(pred.select("doc_id", "class_id", "pred_class_id", "confidence"), ["confidence"])


@query("classification_report")
def q_classification_report(spark, sf):
    _, _, pred = _nb_holdout(spark, sf)
    return md.classification_report(pred)


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    _, _, pred = _nb_holdout(spark, sf)
    return md.confusion_matrix(pred)


# --- MLlib pipelines (rows-only checks) -----------------------------------------------

from corpusflow.operators import ml_chain as mc  # noqa: E402
from corpusflow.operators import score as sc  # noqa: E402
from corpusflow.operators import spectral as sp  # noqa: E402


def _ml_rows(spark, sf):
    """One row per document for the pipelines."""
    return mc.vector_rows(_features(spark, sf))


def _ml_eval(name):
    """M5-M9: vectors, selection, scaling and classifier fit in each of 3 folds."""
    def run(spark, sf):
        return mc.compare(_ml_rows(spark, sf), [name]).drop("time_seconds")
    return run


QUERIES["logreg_eval"] = _ml_eval("logistic_regression")
QUERIES["linear_svm_eval"] = _ml_eval("linear_svm")
QUERIES["rf_eval"] = _ml_eval("random_forest")
QUERIES["gbt_eval"] = _ml_eval("gradient_boosting")
QUERIES["mlp_eval"] = _ml_eval("neural_network")
QUERIES["nb_eval"] = _ml_eval("multinomial_nb")
QUERIES["complement_nb_eval"] = _ml_eval("complement_nb")


@query("model_comparison")
def q_model_comparison(spark, sf):
    """Models in 3 folds, ranked; a failed one is listed last with its error."""
    from pyspark.sql import Window
    found = mc.compare(_ml_rows(spark, sf), ["multinomial_nb", "complement_nb", "logistic_regression", "random_forest"])
    order = Window.orderBy(F.desc_nulls_last("mean_accuracy"), "name")  # one row per model
    return found.select(F.row_number().over(order).alias("rank"), "*")


@query("comparison_advice")
def q_comparison_advice(spark, sf):
    return sc.comparison_advice(mc.compare(_ml_rows(spark, sf), ["multinomial_nb", "complement_nb", "logistic_regression"]))


@query("pipeline_store")
def q_pipeline_store(spark, sf):
    """A fitted chain saved, published, loaded and used; ``same`` compares it with the one in memory."""
    rows = _ml_rows(spark, sf)
    model = mc.chain("multinomial_nb").fit(rows.filter("fold <> 0"))
    registry = store.ModelRegistry(spark, _folder(spark, "registry"))
    registry.publish(registry.save(model, "v1"))
    held = rows.filter("fold = 0")
    loaded = registry.load().transform(held).select("doc_id", "label", "prediction")
    here = model.transform(held).select(F.col("doc_id").alias("d"), F.col("prediction").alias("p"))
    return loaded.join(here, F.col("doc_id") == F.col("d")).select("doc_id", "label", "prediction", (F.col("prediction") == F.col("p")).alias("same"))


@query("rf_importance")
def q_rf_importance(spark, sf):
    """Importances of all features."""
    return mc.importances(_ml_rows(spark, sf)).drop("kind")


@query("rf_importance_kinds")
def q_rf_importance_kinds(spark, sf):
    """Sum and mean of the importances of each kind of feature."""
    return mc.importance_by_kind(mc.importances(_ml_rows(spark, sf)))


def _components(spark, sf):
    f = _features(spark, sf)
    return sp.principal_components(f.matrix, f.docs.count(), 100)


@query("pca_variance")
def q_pca_variance(spark, sf):
    """Up to 100 components of all features."""
    return _components(spark, sf)


@query("pca_components_needed")
def q_pca_components_needed(spark, sf):
    """Components for 80, 90 and 95% of the variance, null if 100 are not enough."""
    return sp.components_needed(_components(spark, sf))


#: Features of the correlation analysis.
N_CORRELATED = 1000


def _correlations(f):
    """Best features by F, rounded so that equal scores stay equal whatever the order of the sums."""
    best = se.select_k_best(se.f_score(f.matrix, f.labels).withColumn("score", F.round("score", 6)), N_CORRELATED).select("feature")
    return sp.correlated_pairs(f.matrix, sp.numbered_features(best), N_CORRELATED, f.n_docs)


@query("feature_correlation")
def q_feature_correlation(spark, sf):
    """Pearson among the best 1,000 features, in numbers."""
    return sp.pair_summary(_correlations(_features(spark, sf)))


@query("correlated_pairs")
def q_correlated_pairs(spark, sf):
    """The pairs by name."""
    r = F.round("r", 6)
    return (_correlations(_features(spark, sf)).select("feature_1", "feature_2", r.alias("r")).filter(F.abs("r") > 0.5)
            .withColumn("high", F.abs("r") > 0.8))


#: C and L1 share of the reference's grids; both solvers of a penalty have the same optimum, so each is one cell here.
LR_CELLS = [*[(c, l1) for c in (0.1, 0.5, 1.0, 2.0, 5.0) for l1 in (0.0, 1.0)],
            *[(c, l1) for c in (0.1, 0.5, 1.0, 2.0) for l1 in (0.1, 0.5, 0.7, 0.9)]]


@query("logreg_grid")
def q_logreg_grid(spark, sf):
    """200 features and scaling fit in each of 3 folds; the elastic net wins only if it is better."""
    f = _features(spark, sf)
    split = md.split_holdout(f.labels)
    rows = mc.vector_rows(f).drop("fold").join(split.select("doc_id", "is_test"), "doc_id")
    folds = md.kfold_assign(split.filter(~F.col("is_test")).select("doc_id", "class_id"), 3).select("doc_id", "fold")
    rows = mc.counted(materialised(rows.join(folds, "doc_id", "left")))
    train = rows.filter(~F.col("is_test"))
    with ThreadPool(3) as pool:  # a job of a small table leaves most cores idle
        each = pool.map(lambda j: mc.logistic_cells(train.filter(F.col("fold") != j), train.filter(F.col("fold") == j), LR_CELLS), range(3))
    mean = {cell: sum(e[cell] for e in each) / 3 for cell in LR_CELLS}
    best = max(LR_CELLS, key=lambda cell: (mean[cell], cell[1] in (0.0, 1.0)))
    test_acc = mc.logistic_cells(train, rows.filter("is_test"), [best])[best]
    cells = [(c, l1, mean[c, l1], test_acc) for c, l1 in LR_CELLS]
    return spark.createDataFrame(cells, "c double, elastic_net double, cv_accuracy double, best_test_accuracy double")


# --- streaming twins -------------------------------------------------------------------

from corpusflow.streaming import monitor_stream as ms  # noqa: E402


@query("stream_hourly_kpis")
def q_stream_hourly_kpis(spark, sf):
    out = ms.run_to_table(ms.hourly_kpis(ms.request_stream(spark, sf)), "hourly_kpis")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "requests", F.col("errors").cast("long").alias("errors"),
                      F.round("avg_response_time", 6).alias("avg_response_time"))


@query("stream_sliding_kpis")
def q_stream_sliding_kpis(spark, sf):
    out = ms.run_to_table(ms.sliding_kpis(ms.request_stream(spark, sf)), "sliding_kpis")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "requests", F.round("error_rate_percent", 6).alias("error_rate_percent"), F.round("p95", 6).alias("p95"))


@query("stream_running_perf")
def q_stream_running_perf(spark, sf):
    out = ms.run_to_table(ms.running_perf(ms.prediction_stream(spark, sf)), "running_perf", mode="complete")
    return _r6(out, ["avg_preprocessing_time", "avg_prediction_time", "avg_confidence"])


@query("stream_alerts")
def q_stream_alerts(spark, sf):
    out = ms.run_to_table(ms.alert_stream(ms.hourly_kpis(ms.request_stream(spark, sf)), 30.0), "alerts")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "requests", F.col("errors").cast("long").alias("errors"), "alert")


@query("stream_dedup")
def q_stream_dedup(spark, sf):
    s = ms.with_event_time(ms.table_stream(spark, sf, "events")).select(
        "event_id", "ts", tx.sha256_prefix(F.col("props")).alias("input_hash"))
    out = ms.run_to_table(ms.dedup_by_hash(s, "input_hash", "1 hour"), "dedup")
    return out.agg(F.count(F.lit(1)).alias("n_kept"))


from corpusflow.streaming import score_stream as ss  # noqa: E402
from corpusflow.streaming import state as st  # noqa: E402


@query("stream_newest")
def q_stream_newest(spark, sf):
    """Drift of each model version from the newest 100 of its last 1,000 predictions, held as state."""
    predictions = ms.prediction_stream(spark, sf).withColumn("model_version", F.concat(F.lit("v"), (F.col("seq") % 3).cast("string")))
    reports = ms.run_to_table(st.newest_predictions(predictions), "newest", mode="update")
    return st.drift_by_version(st.latest_window(reports))


@query("stream_quiet")
def q_stream_quiet(spark, sf):
    """Minutes that end ten without requests and absences, per endpoint, told by event-time timers."""
    out = ms.run_to_table(st.quiet_alerts(ms.request_stream(spark, sf), F.col("endpoint")), "quiet")
    return out.select("key", "alert", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"))


@query("stream_bursts")
def q_stream_bursts(spark, sf):
    """Error bursts and slow windows of 5 minutes."""
    out = ms.run_to_table(st.burst_alerts(ms.request_stream(spark, sf), error_count=1, p95_ms=450.0), "bursts")
    return out.select("alert", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.round("value", 6).alias("value"))


TURN = "conv_id long, turn long, role string, text string"


def _turn_lines(spark, sf):
    """The conversations as JSON lines in a folder; every seventh line is cut off, every eleventh text is blank."""
    turns = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", F.when(
        (F.col("conv_id") + F.col("turn")) % 11 == 0, F.lit("  ")).otherwise(F.col("text")).alias("text"))
    line = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    cut = (F.col("conv_id") * 3 + F.col("turn")) % 7 == 0
    folder = _folder(spark, "lines")
    turns.select(F.when(cut, F.substring(line, 1, 25)).otherwise(line).alias("value")).write.text(folder)
    return folder


def _score_lines(spark, sf):
    from pyspark.sql.types import StructType
    f = _features(spark, sf)
    model = mc.chain("multinomial_nb").fit(mc.vector_rows(f).checkpoint())
    index = fe.label_index(f.docs, "sample_name", null_as="unknown")
    return ss.score_lines(ss.line_stream(spark, _turn_lines(spark, sf)), StructType.fromDDL(TURN), F.struct("conv_id", "turn"), model, index)


@query("score_stream")
def q_score_stream(spark, sf):
    """JSON lines validated and scored per micro-batch with the fitted chain."""
    scores, _ = _score_lines(spark, sf)
    return scores.select("doc_id.conv_id", "doc_id.turn", "pred_class_id", F.round("confidence", 6).alias("confidence"))


@query("stream_quarantine")
def q_stream_quarantine(spark, sf):
    """What was scored and what was rejected, by reason."""
    scores, rejects = _score_lines(spark, sf)
    return (scores.agg(F.count(F.lit(1)).alias("n")).select(F.lit("scored").alias("outcome"), "n")
            .unionByName(rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))))


@query("sketch_report")
def q_sketch_report(spark, sf):
    """Hourly sketches of the log, written once and merged per endpoint."""
    from corpusflow.operators import sketches as sk
    path = store.write_table(sk.hourly_sketches(_req(spark, sf)), _folder(spark, "sketches"))
    out = sk.merged(spark.read.parquet(path))
    return out.select("endpoint", "requests", "errors", F.round("avg_response_time_ms", 6).alias("avg_response_time_ms"))


@query("sketch_percentiles")
def q_sketch_percentiles(spark, sf):
    """Approximate distinct clients and latency percentiles per endpoint, from merged hourly sketches."""
    from corpusflow.operators import sketches as sk
    path = store.write_table(sk.hourly_sketches(_req(spark, sf)), _folder(spark, "sketches"))
    return sk.merged(spark.read.parquet(path))


# --- scoring, jobs, sweeps -----------------------------------------------------------------

def _bench_features(spark, sf, f):
    bench = read_table(spark, sf, "benchmark")
    new = bench.select(F.col("item_id").alias("doc_id"), F.lit(None).cast("string").alias("sample_name"),
                       F.lit(None).cast("string").alias("description"),
                       tx.clean_text(F.col("text")).alias("transcription"))
    new = new.withColumn("transcription_cleaned", tx.normalize_conservative(F.col("transcription")))
    counts = fe.term_counts(new, "transcription_cleaned", ngram=(1, 2), stop_words=fe.english_stop_words())
    t = fe.tfidf(counts, f.vocab)
    dense = fe.dense_features(new, fe.label_index(f.docs, "sample_name", null_as="unknown"), serving=True)
    return bench, new, fe.feature_matrix(t, dense)


def _score_bench(spark, sf):
    f = _features(spark, sf)
    model = md.nb_fit(f.matrix, f.labels.select("doc_id", "class_id"), n_features=f.n_features)
    bench, new, mat = _bench_features(spark, sf, f)
    pred = md.nb_predict(model, mat, new.select("doc_id")).persist(StorageLevel.MEMORY_AND_DISK)
    return f, bench, pred


@query("score_top5")
def q_score_top5(spark, sf):
    f, _, pred = _score_bench(spark, sf)
    out = sc.decode_top(pred, fe.label_index(f.docs, "label"))
    return out.select(F.col("doc_id").alias("item_id"), "rank", "class", F.round("confidence", 6).alias("confidence"))


@query("prediction_log")
def q_prediction_log(spark, sf):
    """Rows of all fields, appended to a log table twice (two deployments) and read back."""
    f, bench, pred = _score_bench(spark, sf)
    path, index = _folder(spark, "prediction_log"), fe.label_index(f.docs, "label")
    for hour, version in enumerate(("v1", "v2")):
        texts = bench.select(F.col("item_id").alias("doc_id"), "text",
                             F.timestamp_seconds(F.lit(1704067200 + 3600 * hour) + F.col("item_id")).alias("ts"))
        rows = sc.prediction_log_rows(texts, pred, index, model_version=version, model_loaded_at="2024-01-01T00:00:00Z", preprocessing_ms=2.0, prediction_ms=1.0)
        store.write_table(rows, path, mode="append", partition_by=("model_version",))
    log = spark.read.parquet(path)
    names = [c.name for c in logs.PREDICTION_SCHEMA]
    return log.select(F.col("doc_id").alias("item_id"), *[F.round(c, 6).alias(c) if c == "confidence" else F.col(c) for c in names])


def _text_predictions(spark, sf):
    """Predictions over the documents, in the order of doc_id, with the statistics of their texts."""
    d = documents(spark, sf)
    stats = tx.text_stats(F.col("text"))
    return d.select(F.col("doc_id").alias("seq"), F.timestamp_seconds("doc_id").alias("ts"), F.lit("v1").alias("model_version"), F.col("lang").alias("prediction"),
                    (F.lit(1.0) / (F.lit(1.0) + F.length("text") / F.lit(2000.0))).alias("confidence"),
                    *[stats[c].cast("double").alias(c) for c in ("text_length", "word_count", "avg_word_length")])


@query("drift_text_stats")
def q_drift_text_stats(spark, sf):
    """The drift report with mean and deviation of text statistics."""
    return mon.drift_report(_text_predictions(spark, sf), 100, buffer=1000, stat_cols=("text_length", "word_count", "avg_word_length"))


@query("score_errors")
def q_score_errors(spark, sf):
    """Error rows of rejected texts; every eleventh text of the conversations is blank."""
    turns = read_table(spark, sf, "conversations").select((F.col("conv_id") * 1000000 + F.col("turn")).alias("doc_id"), F.when(
        (F.col("conv_id") + F.col("turn")) % 11 == 0, F.lit("  ")).otherwise(F.col("text")).alias("text"))
    _, rejected = cl.valid_text(turns, "text")
    return sc.error_log(rejected).select(F.col("id").alias("doc_id"), "event_type", "input_hash", "error_type", "error_message", "total_errors")


@query("model_gate")
def q_model_gate(spark, sf):
    _, _, pred = _nb_holdout(spark, sf)
    acc = pred.agg(F.avg((F.col("class_id") == F.col("pred_class_id")).cast("double")).alias("accuracy"))
    return acc.select(F.round("accuracy", 6).alias("accuracy"), sc.model_gate(F.col("accuracy")).alias("status"))


@query("leaderboard")
def q_leaderboard(spark, sf):
    rows = []
    f = _features(spark, sf)
    split = md.split_holdout(f.labels).persist(StorageLevel.MEMORY_AND_DISK)
    train = split.filter(~F.col("is_test")).select("doc_id", "class_id")
    test = split.filter(F.col("is_test")).select("doc_id", "class_id")
    for name, kw in [("multinomial_nb", {}), ("multinomial_nb_uniform_prior", {"fit_prior": False}),
                     ("complement_nb", {"complement": True})]:
        model = md.nb_fit(f.matrix.join(train, "doc_id", "left_semi"), train, n_features=f.n_features, **kw)
        pred = md.nb_predict(model, f.matrix.join(test, "doc_id", "left_semi"), test).join(test, "doc_id")
        rows.append(pred.agg(F.avg((F.col("class_id") == F.col("pred_class_id")).cast("double"))
                             .alias("accuracy")).select(F.lit(name).alias("name"), "accuracy",
                                                        F.lit("success").alias("status")))
    res = rows[0]
    for r in rows[1:]:
        res = res.unionByName(r)
    k = f.labels.select(F.countDistinct("class_id")).scalar()
    return sc.leaderboard(res, k)


@query("feature_kinds")
def q_feature_kinds(spark, sf):
    f = _features(spark, sf)
    return sc.feature_kinds(f.matrix.select("feature").distinct()).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_features"))


@query("nb_grid")
def q_nb_grid(spark, sf):
    """The reference's 140 cells (5 k x 2 selectors x 7 alphas x 2 priors), selection and scaling fit in each of 3 folds."""
    f = _features(spark, sf)
    return md.nb_grid_cv(f.matrix, f.labels, [300, 400, 500, 600, 750], [0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0])


def _nb_sweep_holdout(f, ranked, ks, alpha=1.0):
    """Hold-out NB accuracy for several top-k feature sets in one plan.

    Each matrix row is repeated for the k values whose top-k contains its
    feature (a fan-out bounded by len(ks)); training sums, class terms,
    deltas and scores then all carry ``k`` as one more group key.
    """
    split = md.split_holdout(f.labels).persist(StorageLevel.MEMORY_AND_DISK)
    ks_arr = F.array(*[F.lit(k) for k in ks])
    m = f.matrix.join(F.broadcast(ranked), "feature").select(
        "doc_id", "feature", "value", F.explode(F.filter(ks_arr, lambda k: F.col("rank") <= k)).alias("k"))
    m = m.join(split.select("doc_id", F.col("class_id").alias("doc_class"), "is_test"), "doc_id")
    train = m.filter(~F.col("is_test"))
    test = m.filter(F.col("is_test")).drop("doc_class")
    a = F.lit(float(alpha))
    nfc = train.groupBy("k", "feature", F.col("doc_class").alias("class_id")).agg(F.sum("value").alias("nfc"))
    sizes = split.filter(~F.col("is_test")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_c"))
    n = sizes.select(F.sum("n_c")).scalar()
    kdf = f.labels.sparkSession.createDataFrame([(k,) for k in ks], "k int")
    mass = nfc.groupBy("k", "class_id").agg(F.sum("nfc").alias("mass_c"))
    cls = (sizes.join(F.broadcast(kdf), how="inner", on=F.lit(True))
           .join(mass, ["k", "class_id"], "left")
           .select("k", "class_id", F.log(F.col("n_c") / n).alias("base"),
                   (F.log(a) - F.log(F.coalesce("mass_c", F.lit(0.0)) + a * F.col("k"))).alias("slope")))
    deltas = nfc.select("k", "feature", "class_id", (F.log(F.col("nfc") + a) - F.log(a)).alias("delta"))
    doc_mass = test.groupBy("k", "doc_id").agg(F.sum("value").alias("x"))
    contrib = test.join(deltas, ["k", "feature"]).groupBy("k", "doc_id", "class_id").agg(
        F.sum(F.col("value") * F.col("delta")).alias("s"))
    docs = (split.filter(F.col("is_test")).select("doc_id", F.col("class_id").alias("true_c"))
            .join(F.broadcast(kdf), how="inner", on=F.lit(True)))
    scored = (docs.join(doc_mass, ["k", "doc_id"], "left").join(F.broadcast(cls), "k")
              .join(contrib, ["k", "doc_id", "class_id"], "left")
              .select("k", "doc_id", "true_c", "class_id",
                      (F.col("base") + F.col("slope") * F.coalesce("x", F.lit(0.0)) + F.coalesce("s", F.lit(0.0)))
                      .alias("score")))
    best = scored.groupBy("k", "doc_id", "true_c").agg(
        F.max_by("class_id", F.struct(F.col("score"), -F.col("class_id"))).alias("pred"))
    return best.groupBy("k").agg(F.round(F.avg((F.col("pred") == F.col("true_c")).cast("double")), 6)
                                 .alias("accuracy"))


@query("k_sweep")
def q_k_sweep(spark, sf):
    """Naive Bayes over several k in 5 folds; selection and scaling are fit per fold."""
    f = _features(spark, sf)
    found = md.nb_grid_cv(f.matrix, f.labels, [150, 175, 200, 225, 250], [1.0], [True], ("f_score",), k_folds=5)
    return found.select("k", F.col("cv_accuracy").alias("accuracy"), F.col("cv_std").alias("std"))


#: Term variants: n-gram sizes, least and most documents, features, analyzer, raw counts.
VARIANTS = {"tfidf_1_2": ((1, 2), 2, 0.95, 2000, "word", False), "tfidf_1_3": ((1, 3), 3, 0.9, 2000, "word", False),
            "count_1_2": ((1, 2), 2, 0.95, 2000, "word", True), "char_3_5": ((3, 5), 2, 0.95, 1500, "char", False)}


@query("variant_compare")
def q_variant_compare(spark, sf):
    """Term variants through the naive Bayes chain in 3 folds; the vocabulary is fit per fold."""
    f = _features(spark, sf)
    rows = mc.vector_rows(f)
    out = mc.compare(rows, ["multinomial_nb"]).withColumn("name", F.lit("assembled"))
    d = materialised(_variant_docs(spark, sf))
    made = {}  # the variants of one term table, weighted or raw, read the same counts
    for name, (*terms, counts) in VARIANTS.items():
        ngram, min_df, max_df, most, analyzer = terms
        limits = {"max_features": most, "min_df": min_df, "max_df": max_df}
        stops = fe.english_stop_words() if analyzer == "word" else None
        joined = fe.joined_terms(d, "t", stop_words=stops, pattern=tx.DEFAULT_TOKEN_PATTERN, analyzer=analyzer)
        if tuple(terms) not in made:
            own = materialised(rows.select("doc_id", "label", "fold").join(joined, "doc_id"))
            made[tuple(terms)] = mc.counted(mc.with_ngrams(own, ngram, analyzer), **limits)
        out = out.unionByName(mc.compare(made[tuple(terms)], ["multinomial_nb"], **limits, counts_only=counts, dense=[])
                              .withColumn("name", F.lit(name)))
    return out.drop("time_seconds")


#: The reference's feature subsets, by kinds; a subset without features is left out.
KINDS = [*[kind for kind, _ in sc.FEATURE_KIND_RULES], "other"]
SUBSETS = {"all": KINDS, "no_keywords": [k for k in KINDS if k != "keywords"], "tfidf_only": ["tfidf"],
           "keywords_only": ["keywords"], "meta_features": ["readability", "length"], "tfidf_plus_meta": ["tfidf", "readability", "length"],
           "without_tfidf": [k for k in KINDS if k != "tfidf"], "entities_only": ["medical_entities"],
           "core_features": ["tfidf", "readability", "length"]}


@query("subset_ablation")
def q_subset_ablation(spark, sf):
    """Every subset through selection, scaling and naive Bayes in 3 folds; k = min(500, n, 0.8 n)."""
    f = _features(spark, sf)
    kinds = sc.feature_kinds(f.matrix.select("feature").distinct()).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r.kind: r["count"] for r in kinds.groupBy("kind").count().collect()}
    out = None
    for name, own in SUBSETS.items():
        n = sum(sizes.get(k, 0) for k in own)
        if n == 0:
            continue
        mat = f.matrix.join(F.broadcast(kinds.filter(F.col("kind").isin(own)).select("feature")), "feature", "left_semi")
        r = md.nb_grid_cv(mat, f.labels, [max(1, min(500, int(0.8 * n)))], [1.0], [True], ("f_score",)).select(
            F.lit(name).alias("name"), F.col("cv_accuracy").alias("accuracy"))
        out = r if out is None else out.unionByName(r)
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    base = out.filter(F.col("name") == "all").select("accuracy").scalar()
    return out.select("name", "accuracy", F.round((F.col("accuracy") - base) * 100, 6).alias("change_pct_points"))


@query("retrain_job")
def q_retrain_job(spark, sf):
    """The job's run rows and its notification."""
    from corpusflow.plans.retrain import retrain
    done = retrain(spark, _raw(spark, sf), _folder(spark, "retrain"))
    return done.runs.table().drop("finished_at", "run_id").unionByName(done.notices().drop("sent_at", "run_id"))


@query("selector_compare")
def q_selector_compare(spark, sf):
    """Selection method x k, ranked on the training rows, each evaluated by hold-out NB accuracy in one plan per method."""
    from pyspark.sql import Window
    f = _features(spark, sf)
    out = None
    ids = md.split_holdout(f.labels).filter(~F.col("is_test")).select("doc_id", "class_id").persist(StorageLevel.MEMORY_AND_DISK)
    fitted = f.matrix.join(ids.select("doc_id"), "doc_id", "left_semi")

    def forest(matrix, labels):
        rows = mc.vector_rows(f).join(labels.select("doc_id"), "doc_id", "left_semi")
        return mc.importances(rows).select("feature", F.col("importance").alias("score"))

    for name, fn in [("f_score", se.f_score), ("mutual_info", se.mutual_info), ("chi2", se.chi2_score), ("random_forest", forest)]:
        best = se.select_k_best(fn(fitted, ids), 500)
        ranked = (best.select("feature", F.row_number().over(Window.orderBy(F.desc("score"), "feature")).alias("rank"))  # 500 rows
                  .persist(StorageLevel.MEMORY_AND_DISK))
        r = _nb_sweep_holdout(f, ranked, [50, 100, 200, 500]).select(F.lit(name).alias("method"), "k", "accuracy")
        out = r if out is None else out.unionByName(r)
    w = Window.orderBy(F.desc("accuracy"), "method", "k")
    return out.select("*", (F.row_number().over(w) == 1).alias("is_best"))


# --- tables on disk ------------------------------------------------------------------------

import uuid  # noqa: E402

from corpusflow.session import ensure_checkpoint_dir  # noqa: E402
from corpusflow.sources import store  # noqa: E402


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_scan")
def q_csv_scan(spark, sf):
    """The documents written as CSV and scanned again."""
    d = documents(spark, sf).select("doc_id", "text", "lang", "source")
    path = store.write_table(d, _folder(spark, "csv"), "csv")
    back = store.read_csv(spark, path, "doc_id long, text string, lang string, source string")
    return back.select("doc_id", F.length("text").alias("chars"), tx.sha256_prefix(F.col("text")).alias("text_hash"), "lang", "source")


@query("table_sink")
def q_table_sink(spark, sf):
    """A table partitioned by language, read back whole."""
    d = documents(spark, sf).select("doc_id", "lang", F.length("text").alias("chars"))
    path = store.write_table(d, _folder(spark, "table"), partition_by=("lang",))
    back = spark.read.schema(d.schema).parquet(path)
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("doc_id").alias("ids"))


@query("feature_store")
def q_feature_store(spark, sf):
    """S3: X and y saved, loaded and joined: features and value sum of every document, with its label."""
    kept = store.FeatureStore(spark, _folder(spark, "features")).save(_features(spark, sf))
    x = kept.load("matrix").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_features"), F.round(F.sum("value"), 6).alias("value_sum"))
    return kept.load("labels").join(x, "doc_id", "left").select("doc_id", "label", "class_id", "n_features", "value_sum")


@query("model_store")
def q_model_store(spark, sf):
    """Naive Bayes trained on the training rows, saved, loaded, and used on the test rows."""
    f = _features(spark, sf)
    split = md.split_holdout(f.labels)
    train = split.filter(~F.col("is_test")).select("doc_id", "class_id")
    test = split.filter(F.col("is_test")).select("doc_id", "class_id")
    path = store.save_nb(md.nb_fit(f.matrix.join(train, "doc_id", "left_semi"), train, n_features=f.n_features), _folder(spark, "nb"))
    pred = md.nb_predict(store.load_nb(spark, path), f.matrix.join(test, "doc_id", "left_semi"), test).join(test, "doc_id")
    return _r6(pred.select("doc_id", "class_id", "pred_class_id", "confidence"), ["confidence"])


@query("run_history")
def q_run_history(spark, sf):
    """One logged step per table of a check job, and the job's last runs."""
    log = store.RunLog(spark, _folder(spark, "runs"))
    for run in ("run-1", "run-2"):
        for no, name in enumerate(("documents", "labels", "events"), 1):
            log.step(run, "count_tables", no, name, lambda name=name: (read_table(spark, sf, name).count(), None))
    runs = log.history(10).select("job", "run_id", "steps", "failed", "last_step", "age")
    sums = log.table().groupBy("job", "run_id").agg(F.sum("value").cast("long").alias("rows_seen"))
    return runs.join(sums, ["job", "run_id"])


@query("normalize_endpoint")
def q_normalize_endpoint(spark, sf):
    """T20 over the page addresses."""
    p = read_table(spark, sf, "pages")
    return p.select("page_id", tx.normalize_endpoint(F.regexp_replace("url", "^https?://[^/]*/?", "")).alias("endpoint"))
