"""Scoring outputs: top-k classes, prediction-log rows, error log, acceptance gate, leaderboard."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as tx


def decode_top(pred: DataFrame, class_index: DataFrame) -> DataFrame:
    """``(doc_id, rank, class, confidence)`` from the ``top`` array of ``nb_predict``.

    The class index has one row per class (bounded) and is broadcast."""
    ex = pred.select("doc_id", F.posexplode("top").alias("pos", "t"))
    idx = class_index.select(F.col("label").alias("class"), F.col("label_id").alias("class_id"))
    return ex.select("doc_id", (F.col("pos") + 1).alias("rank"), F.col("t.class_id").alias("class_id"),
                     F.col("t.confidence").alias("confidence")).join(F.broadcast(idx), "class_id").drop("class_id")


def prediction_log_rows(texts: DataFrame, pred: DataFrame, class_index: DataFrame, ts_col: str = "ts", model_version: str = "v1",
                        model_loaded_at: str | None = None, feature_engine_version: str = "1.0.0", preprocessing_ms: float | None = None,
                        prediction_ms: float | None = None) -> DataFrame:
    """One row per scored text: ``doc_id`` and all fields of ``logs.PREDICTION_SCHEMA``.

    ``preprocessing_ms`` and ``prediction_ms`` are the caller's times per text (a
    batch is timed as a whole).  Memory and processor use belong to a single
    process and stay null here.
    """
    idx = class_index.select(F.col("label").alias("prediction"), F.col("label_id").alias("pred_class_id"))
    # One entry per class: a bounded map from class number to name.
    names = class_index.select(F.map_from_entries(F.collect_list(F.struct(F.col("label_id").cast("int"), "label")))).scalar()
    p = pred.join(F.broadcast(idx), "pred_class_id").withColumn("names", names)
    j = texts.join(p, "doc_id")
    stats = F.from_json(F.to_json(tx.text_stats(F.col("text"))), "map<string,double>")
    top = F.transform("top", lambda t: F.struct(F.col("names")[t["class_id"].cast("int")].alias("class"), t["confidence"].alias("confidence")))
    ms = [F.lit(x).cast("double") for x in (preprocessing_ms, prediction_ms)]
    return j.select(
        "doc_id", F.col(ts_col).cast("string").alias("timestamp"),
        tx.request_id(F.col(ts_col), F.col("text")).alias("request_id"),
        F.lit(model_version).alias("model_version"),
        F.substring("text", 1, 500).alias("input_text"),
        tx.sha256_prefix(F.col("text")).alias("input_hash"),
        F.length("text").cast("long").alias("input_length"),
        "prediction", "confidence", top.alias("top_predictions"),
        ms[0].alias("preprocessing_time_ms"), ms[1].alias("prediction_time_ms"), (ms[0] + ms[1]).alias("total_time_ms"),
        stats.alias("feature_stats"), F.lit(model_loaded_at).cast("string").alias("model_loaded_at"), F.lit(feature_engine_version).alias("feature_engine_version"),
        F.lit(None).cast("double").alias("memory_usage_mb"), F.lit(None).cast("double").alias("cpu_usage_percent"))


def error_log(rejected: DataFrame, text_col: str = "text", id_col: str = "doc_id",
              error_type: str = "ValidationError") -> DataFrame:
    """Error rows for rejected inputs with a running error count (ordered by a numeric id).

    The ids are cut into 256 ranges at approximate quantiles; each range counts
    its own rows and adds the rows of the ranges below.
    """
    cuts = rejected.agg(F.percentile_approx(id_col, [k / 256 for k in range(1, 256)], 10_000)).scalar()
    ranged = rejected.withColumn("__cuts", cuts)
    ranged = ranged.withColumn("__range", F.coalesce(F.size(F.filter("__cuts", lambda c: c < F.col(id_col))), F.lit(0)))
    below = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    up_to = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows at most
    below = below.select(F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(up_to), F.lit(0)).alias("__below"))
    w = Window.partitionBy("__range").orderBy(id_col)
    counted = ranged.withColumn("__own", F.row_number().over(w))
    return counted.join(below, F.col("__range") == F.col("__r")).select(
        F.lit("PREDICTION_ERROR").alias("event_type"), F.col(id_col).alias("id"),
        tx.sha256_prefix(F.coalesce(F.col(text_col), F.lit(""))).alias("input_hash"),
        F.lit(error_type).alias("error_type"), F.col("reject_reason").alias("error_message"),
        (F.col("__own") + F.col("__below")).alias("total_errors"))


def model_gate(accuracy_col, fail_below: float = 0.4, warn_below: float = 0.6) -> DataFrame:
    """Acceptance status from one accuracy value: fail < 0.4, warning < 0.6, else passed
    (a failing model is never downgraded to a warning)."""
    return (F.when(accuracy_col < fail_below, F.lit("failed"))
            .when(accuracy_col < warn_below, F.lit("warning")).otherwise(F.lit("passed")))


def leaderboard(results: DataFrame, n_classes, baseline: float = 0.37) -> DataFrame:
    """Rank successful experiments by accuracy; compare with a baseline and with random."""
    ok = results.filter(F.col("status") == "success")
    w = Window.orderBy(F.desc("accuracy"), F.asc("name"))
    ranked = ok.select("name", "accuracy", F.rank().over(w).alias("rank"))
    band = (F.when(F.col("accuracy") > 0.45, F.lit("excellent"))
            .when(F.col("accuracy") > 0.40, F.lit("good"))
            .when(F.col("accuracy") > baseline, F.lit("baseline")).otherwise(F.lit("below_baseline")))
    return ranked.select("rank", "name", F.round("accuracy", 6).alias("accuracy"),
                         F.round(F.col("accuracy") - baseline, 6).alias("vs_baseline"),
                         F.round(F.col("accuracy") / (F.lit(1.0) / n_classes), 6).alias("vs_random"),
                         band.alias("band"))


def comparison_advice(results: DataFrame, baseline: float = 0.37, fast_seconds: float = 10.0, fast_accuracy: float = 0.35) -> DataFrame:
    """What to do after a comparison: (step, advice, names).

    ``results`` has one row per model (name, mean_accuracy, time_seconds, status).
    Rows: how far the best model is above the baseline, the three best, the two
    best that are fast, models to combine (forest, boosting or logistic ones
    among the five best, if there are two), the one to tune, and those that failed.
    """
    ok = results.filter(F.col("status") == "success")
    order = F.struct(-F.col("mean_accuracy"), F.col("name"))
    # One entry per model: a bounded list.
    best = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), "name", "mean_accuracy", "time_seconds"))),
                       lambda m: F.struct(m["name"].alias("name"), m["mean_accuracy"].alias("a"), m["time_seconds"].alias("t")))
    one = ok.agg(best.alias("m")).join(results.agg(F.sort_array(F.collect_list(F.when(F.col("status") != "success", F.col("name")))).alias("bad")))
    names = lambda a: F.transform(a, lambda m: m["name"])
    top = F.get("m", F.lit(0))["a"]
    band = (F.when(top > 0.45, F.lit("STRONG")).when(top > 0.40, F.lit("ABOVE_BASELINE")).when(top > baseline, F.lit("SLIGHTLY_ABOVE_BASELINE"))
            .otherwise(F.lit("NOT_ABOVE_BASELINE")))
    fast = F.filter("m", lambda m: (m["t"] < fast_seconds) & (m["a"] > fast_accuracy))
    mixed = F.filter(F.slice("m", 1, 5), lambda m: m["name"].rlike("(?i)forest|boost|logistic"))
    rows = [(1, band, F.slice(names(F.col("m")), 1, 1)), (2, F.lit("FOCUS_ON"), F.slice(names(F.col("m")), 1, 3)),
            (3, F.lit("ITERATE_WITH"), F.slice(names(fast), 1, 2)),
            (4, F.lit("COMBINE"), F.when(F.size(mixed) >= 2, F.slice(names(mixed), 1, 3)).otherwise(F.array().cast("array<string>"))),
            (5, F.lit("TUNE"), F.slice(names(F.col("m")), 1, 1)), (6, F.lit("REPAIR"), F.col("bad"))]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("step"), a.alias("advice"), n.alias("names")) for k, a, n in rows])).alias("r")
    return one.select(each).select("r.*").filter(F.size("names") > 0).withColumn("names", F.array_join("names", ", "))


# Feature-kind rules on the lower-case name, first match wins; a
# name of three letters or more without an underscore is a TF-IDF word.
FEATURE_KIND_RULES = [
    ("tfidf", r"tfidf_|word_|token_|^\p{L}{3,}$"),
    ("keywords", r"keyword_|medical_keyword|specialty_keyword"),
    ("readability", r"flesch|kincaid|coleman|automated_readability|gunning_fog|smog|syllable|sentence_count"),
    ("length", r"length|word_count|char_count|line_count|avg_word_length|avg_sentence_length"),
    ("medical_entities", r"entity_|medical_entity|ner_|drug_|disease_|symptom_"),
]


def feature_kinds(features: DataFrame, col: str = "feature") -> DataFrame:
    kind = None
    for name, rx in FEATURE_KIND_RULES:
        cond = F.lower(col).rlike(rx)
        kind = F.when(cond, F.lit(name)) if kind is None else kind.when(cond, F.lit(name))
    return features.select(col, kind.otherwise(F.lit("other")).alias("kind"))
