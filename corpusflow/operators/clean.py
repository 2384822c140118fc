"""Cleaning of a labelled text table: missing rows, short texts, outliers, classes.

``clean_pipeline`` composes the steps in the reference's order:
missing -> text quality -> outliers -> class reduction.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as tx


def clean_missing(df: DataFrame, text_col: str = "transcription",
                  drop_cols=("keywords", "Unnamed: 0")) -> DataFrame:
    """Drop rows with null text, then drop the listed columns when present."""
    out = df.na.drop(subset=[text_col]) if text_col in df.columns else df
    present = [c for c in drop_cols if c in out.columns]
    return out.drop(*present)


def filter_short(df: DataFrame, text_col: str = "transcription", min_length: int = 50) -> DataFrame:
    """Keep texts of at least ``min_length`` characters (nulls go too)."""
    return df.filter(F.length(text_col) >= min_length)


def handle_outliers(df: DataFrame, text_col: str = "transcription", method: str = "keep",
                    max_length: int = 8000) -> DataFrame:
    """``cap``: cut to the first max_length characters; ``remove``: keep len <= max_length;
    ``keep``: identity."""
    if method == "cap":
        return df.withColumn(text_col, F.when(F.length(text_col) > max_length,
                                              F.substring(text_col, 1, max_length))
                             .otherwise(F.col(text_col)))
    if method == "remove":
        return df.filter(F.length(text_col) <= max_length)
    if method == "keep":
        return df
    raise ValueError(f"unknown outlier method {method!r}")


def clean_text_quality(df: DataFrame, text_col: str = "transcription", min_length: int = 50,
                       legacy_quotes: bool = False, clean=tx.clean_text) -> DataFrame:
    """Short-text filter, then symbol spelling / non-ASCII strip / whitespace and
    punctuation collapse on the text column."""
    return filter_short(df, text_col, min_length).withColumn(
        text_col, clean(F.col(text_col), legacy_quotes))


def clean_text_effect(df: DataFrame, text_col: str = "transcription", min_length: int = 50,
                      legacy_quotes: bool = False) -> DataFrame:
    """Rows with non-ASCII characters before and after cleaning, and rows removed as short."""
    kept = filter_short(df, text_col, min_length)
    cleaned = tx.clean_text(F.col(text_col), legacy_quotes)
    before = df.agg(F.count(F.lit(1)).alias("n_before"))
    after = kept.agg(
        F.count(F.lit(1)).alias("n_after"),
        F.sum(tx.has_non_ascii(F.col(text_col)).cast("long")).alias("non_ascii_before"),
        F.sum(tx.has_non_ascii(cleaned).cast("long")).alias("non_ascii_after"))
    n_before = before.select("n_before").scalar()
    return after.select(
        n_before.alias("n_before"), F.col("n_after"),
        (n_before - F.col("n_after")).alias("short_removed"),
        F.coalesce("non_ascii_before", F.lit(0)).cast("long").alias("non_ascii_before"),
        F.coalesce("non_ascii_after", F.lit(0)).cast("long").alias("non_ascii_after"))


def top_classes(df: DataFrame, target_col: str, n_classes: int) -> DataFrame:
    """The n most frequent non-null labels (ties by label); at most n rows."""
    return (df.filter(F.col(target_col).isNotNull())
            .groupBy(F.col(target_col).alias("__keep"))
            .agg(F.count(F.lit(1)).alias("__n"))
            .orderBy(F.desc("__n"), F.asc("__keep")).limit(n_classes).select("__keep"))


def reduce_classes(df: DataFrame, target_col: str = "medical_specialty", n_classes: int = 15,
                   other: str = "Other") -> DataFrame:
    """Keep the n most frequent labels; every other label *and null* becomes ``other``.

    The kept-label table has at most ``n_classes`` rows (a limit), so it is
    broadcast; the big side is never shuffled.
    """
    keep = top_classes(df, target_col, n_classes)
    joined = df.join(F.broadcast(keep), df[target_col] == keep["__keep"], "left")
    return joined.withColumn(target_col, F.when(F.col("__keep").isNotNull(), F.col(target_col))
                             .otherwise(F.lit(other))).drop("__keep")


def class_distribution(df: DataFrame, target_col: str = "medical_specialty") -> DataFrame:
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(F.col(target_col).alias("class")).agg(F.count(F.lit(1)).alias("n"))
            .select("class", "n", F.round(F.lit(100.0) * F.col("n") / total, 6).alias("pct")))


def clean_pipeline(df: DataFrame, text_col: str = "transcription",
                   target_col: str = "medical_specialty", n_classes: int = 15,
                   outlier_method: str = "keep", max_text_length: int = 8000,
                   min_text_length: int = 50, legacy_quotes: bool = False, clean=tx.clean_text) -> DataFrame:
    """missing -> text quality -> outliers -> class reduction, as one lazy plan.

    Texts stay whole unless ``outlier_method`` asks for a cut or a filter.
    """
    out = clean_missing(df, text_col)
    out = clean_text_quality(out, text_col, min_text_length, legacy_quotes, clean)
    out = handle_outliers(out, text_col, outlier_method, max_text_length)
    return reduce_classes(out, target_col, n_classes)


def clean_summary(raw: DataFrame, cleaned: DataFrame, text_col: str = "transcription",
                  target_col: str = "medical_specialty") -> DataFrame:
    """Rows and classes before/after, removed %, length range and mean after cleaning."""
    before = raw.agg(F.count(F.lit(1)).alias("rows_before"),
                     F.countDistinct(target_col).alias("classes_before"))
    after = cleaned.agg(F.count(F.lit(1)).alias("rows_after"),
                        F.countDistinct(target_col).alias("classes_after"),
                        F.min(F.length(text_col)).cast("long").alias("min_chars"),
                        F.max(F.length(text_col)).cast("long").alias("max_chars"),
                        F.round(F.avg(F.length(text_col)), 6).alias("avg_chars"))
    b = before.select(F.struct("*")).scalar()
    return after.select(
        b["rows_before"].alias("rows_before"), "rows_after",
        (b["rows_before"] - F.col("rows_after")).alias("rows_removed"),
        F.round(F.lit(100.0) * (b["rows_before"] - F.col("rows_after")) / b["rows_before"], 6)
        .alias("removed_pct"),
        b["classes_before"].alias("classes_before"), "classes_after",
        "min_chars", "max_chars", "avg_chars")


def valid_text(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Split into (valid rows with stripped text, rejected rows with a reason).

    Empty, blank or null text is rejected; valid text is stripped of leading and
    trailing whitespace.
    """
    stripped = F.trim(F.regexp_replace(F.col(text_col), f"^[{tx.WS_CLASS}]+|[{tx.WS_CLASS}]+$", ""))
    ok = stripped.isNotNull() & (stripped != "")
    valid = df.filter(ok).withColumn(text_col, stripped)
    reason = F.when(F.col(text_col).isNull(), F.lit("null")).when(F.col(text_col) == "", F.lit("empty")) \
        .otherwise(F.lit("blank"))
    rejected = df.filter(~F.coalesce(ok, F.lit(False))).withColumn("reject_reason", reason)
    return valid, rejected


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Non-numeric cells to null to 0.0 (``try_cast``; safe under ANSI mode)."""
    return df.select(*[F.coalesce(F.expr(f"try_cast(`{c}` as double)"), F.lit(0.0)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])
