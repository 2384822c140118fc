"""Profiling of a labelled text table (class counts, nulls, lengths, quality, vocabulary).

Each function is lazy and returns a small report DataFrame.  All of them are
single-pass aggregates (partial aggregation before the shuffle); totals come in
as scalar subqueries rather than joins.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.functions.stats import linear_percentiles
from corpusflow.session import ensure_checkpoint_dir

# Word filters of the vocabulary reports.
OVERLAP_COMMON_WORDS = ["the", "and", "that", "this", "with", "from", "they", "have",
                        "were", "been", "their"]
TOP_TERM_STOP_WORDS = ["the", "and", "or", "but", "in", "on", "at", "to", "for", "of",
                       "with", "by", "is", "was", "are", "were", "a", "an"]


def _pct(x, total):
    return F.round(F.lit(100.0) * x / total, 6)


def table_profile(df: DataFrame) -> DataFrame:
    """Shape and dtypes: one row per column with position, type, row count."""
    n = df.select(F.count(F.lit(1))).scalar()
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    spark = df.sparkSession
    meta = spark.createDataFrame(rows, "position int, column_name string, data_type string")
    return meta.select("position", "column_name", "data_type", n.alias("n_rows"))


def class_top_n(df: DataFrame, target_col: str, n: int = 10) -> DataFrame:
    """Top-n classes by count with their share of all rows (ties by name)."""
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.groupBy(F.col(target_col).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc_nulls_last("class")).limit(n)
    return top.select("class", "n", _pct(F.col("n"), total).alias("pct"))


def class_counts(df: DataFrame, target_col: str) -> DataFrame:
    return df.groupBy(F.col(target_col).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Null count and % per column, one pass over the table."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.sum(F.col(c).isNull().cast("long")).alias(f"__null_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    stacked = one.select(F.col("__n"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__null_{i}").alias("null_count"))
        for i, c in enumerate(cols)])).alias("s"))
    out = stacked.select(F.col("s.column_name").alias("column_name"),
                         F.col("s.null_count").alias("null_count"),
                         _pct(F.col("s.null_count"), F.col("__n")).alias("null_pct"))
    if only_missing:
        out = out.filter(F.col("null_count") > 0)
    return out


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier identical row (counted, never removed)."""
    cols = cols or df.columns
    row = F.struct(*[F.col(c) for c in cols])
    groups = df.groupBy(F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256).alias("row")).agg(F.count(F.lit(1)).alias("c"))
    return groups.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
                      F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n_rows"))


def class_tiers(df: DataFrame, target_col: str, thresholds=(100, 20, 5)) -> DataFrame:
    """Classes and samples per size tier; a last 'rare' tier below the smallest threshold."""
    ts = list(thresholds)
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.filter(F.col(target_col).isNotNull()).groupBy(target_col).agg(
        F.count(F.lit(1)).alias("n"))
    tier = None
    for i, t in enumerate(ts):
        cond = F.col("n") >= t if i == 0 else (F.col("n") >= t) & (F.col("n") < ts[i - 1])
        tier = (F.when(cond, F.lit(f"tier_{i + 1}")) if tier is None
                else tier.when(cond, F.lit(f"tier_{i + 1}")))
    tier = tier.when(F.col("n") < min(ts), F.lit("tier_rare"))
    names = [f"tier_{i + 1}" for i in range(len(ts))] + ["tier_rare"]
    lows = list(ts) + [0]
    highs = [None] + [t - 1 for t in ts[:-1]] + [min(ts) - 1]
    spark = df.sparkSession
    tiers = spark.createDataFrame(list(zip(names, lows, highs)),
                                  "tier string, min_count int, max_count int")
    agg = counts.select(tier.alias("tier"), "n").groupBy("tier").agg(
        F.count(F.lit(1)).alias("classes"), F.sum("n").alias("samples"))
    return (tiers.join(F.broadcast(agg), "tier", "left")
            .select("tier", "min_count", "max_count",
                    F.coalesce("classes", F.lit(0)).cast("long").alias("classes"),
                    F.coalesce("samples", F.lit(0)).cast("long").alias("samples"),
                    _pct(F.coalesce("samples", F.lit(0)), total).alias("pct")))


def _percentile_row(df: DataFrame, cols: dict, ps: list[float]) -> Column:
    """The percentiles of ``cols`` as one map: name -> p -> value."""
    found = linear_percentiles(df, cols, ps)
    return found.agg(F.map_from_entries(F.collect_list(F.struct("name", "percentiles")))).scalar()


def _sizes(df: DataFrame) -> DataFrame:
    """``df`` (a few lengths per text) written once: reports read it several times, the texts only here."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_length_stats(df: DataFrame, text_cols=("description", "transcription")) -> DataFrame:
    """Mean/median/min/max characters and mean/median words per text column (non-null rows)."""
    held = [c for c in text_cols if c in df.columns]
    sizes = {f"{c}_{kind}": size for c in held for kind, size in (("chars", F.length(F.col(c))), ("words", F.when(F.col(c).isNotNull(), tx.word_count(F.col(c)))))}
    wide = _sizes(df.select(*[size.alias(n) for n, size in sizes.items()]))
    median = _percentile_row(wide, {n: F.col(n) for n in sizes}, [0.5])
    one = wide.agg(*[f(n).alias(f"{n}_{f.__name__}") for n in sizes for f in (F.avg, F.min, F.max)]).withColumn("m", median)
    rows = [F.struct(F.lit(c).alias("column_name"), F.round(f"{c}_chars_avg", 6).alias("char_mean"), F.round(F.col("m")[f"{c}_chars"][0.5], 6).alias("char_median"),
                     F.round(f"{c}_words_avg", 6).alias("word_mean"), F.round(F.col("m")[f"{c}_words"][0.5], 6).alias("word_median"),
                     F.col(f"{c}_chars_min").cast("long").alias("char_min"), F.col(f"{c}_chars_max").cast("long").alias("char_max")) for c in held]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def iqr_outliers(df: DataFrame, text_col: str = "transcription") -> DataFrame:
    """IQR bounds and strict outlier counts for characters and words, plus warnings."""
    base = _sizes(df.filter(F.col(text_col).isNotNull()).select(
        F.length(text_col).alias("chars"), tx.word_count(F.col(text_col)).alias("words")))
    cuts = _percentile_row(base, {"chars": F.col("chars"), "words": F.col("words")}, [0.25, 0.5, 0.75])
    q = base.agg(F.count(F.lit(1)).alias("n"), F.max("chars").alias("cmax")).withColumn("m", cuts)
    q = q.select("n", "cmax", *[F.col("m")[name][p].alias(a) for name, p, a in (
        ("chars", 0.25, "cq1"), ("chars", 0.75, "cq3"), ("words", 0.25, "wq1"), ("words", 0.75, "wq3"), ("chars", 0.5, "cmed"))])
    q = q.select("*",
                 (F.col("cq1") - 1.5 * (F.col("cq3") - F.col("cq1"))).alias("c_lo"),
                 (F.col("cq3") + 1.5 * (F.col("cq3") - F.col("cq1"))).alias("c_hi"),
                 (F.col("wq1") - 1.5 * (F.col("wq3") - F.col("wq1"))).alias("w_lo"),
                 (F.col("wq3") + 1.5 * (F.col("wq3") - F.col("wq1"))).alias("w_hi"))
    # The bounds are one row, planned once as a scalar subquery next to the base scan.
    bnd = q.select(F.struct(*q.columns)).scalar()
    counts = base.agg(
        F.sum((F.col("chars") < bnd["c_lo"]).cast("long")).alias("char_outliers_low"),
        F.sum((F.col("chars") > bnd["c_hi"]).cast("long")).alias("char_outliers_high"),
        F.sum((F.col("words") < bnd["w_lo"]).cast("long")).alias("word_outliers_low"),
        F.sum((F.col("words") > bnd["w_hi"]).cast("long")).alias("word_outliers_high"))
    out = counts.select(
        bnd["n"].alias("n"),
        F.round(bnd["c_lo"], 6).alias("char_lower"), F.round(bnd["c_hi"], 6).alias("char_upper"),
        F.round(bnd["w_lo"], 6).alias("word_lower"), F.round(bnd["w_hi"], 6).alias("word_upper"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts.columns],
        bnd["cmed"].alias("cmed"), bnd["cmax"].alias("cmax"))
    out = out.select(
        "*",
        F.round(F.lit(100.0) * (F.col("char_outliers_low") + F.col("char_outliers_high")) / F.col("n"), 6)
        .alias("outlier_pct"),
        (F.col("char_outliers_high") > F.col("n") * 0.01).alias("warn_many_long"),
        (F.col("char_outliers_low") > F.col("n") * 0.01).alias("warn_many_short"),
        (F.col("cmax") > F.col("cmed") * 10).alias("warn_extreme_max"))
    return out.drop("cmed", "cmax")


def text_extremes(df: DataFrame, text_col: str, target_col: str, id_col: str = "doc_id") -> DataFrame:
    """Longest and shortest text with its class (ties: smallest id)."""
    base = df.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.length(text_col).alias("chars"),
        F.col(target_col).alias("class"))
    longest = F.max_by(F.struct("id", "chars", "class"), F.struct(F.col("chars"), -F.col("id")))
    shortest = F.min_by(F.struct("id", "chars", "class"), F.struct(F.col("chars"), F.col("id")))
    one = base.agg(longest.alias("l"), shortest.alias("s"))
    return one.select(F.explode(F.array(
        F.struct(F.lit("longest").alias("kind"), F.col("l.id").alias("id"),
                 F.col("l.chars").cast("long").alias("chars"), F.col("l.class").alias("class")),
        F.struct(F.lit("shortest").alias("kind"), F.col("s.id").alias("id"),
                 F.col("s.chars").cast("long").alias("chars"), F.col("s.class").alias("class")))
    ).alias("e")).select("e.*")


def text_quality(df: DataFrame, text_col: str = "transcription") -> DataFrame:
    """Counts and % of quality flags and section words over non-null texts (one pass)."""
    t = F.col(text_col)
    flags = [
        ("non_ascii", tx.has_non_ascii(t)),
        ("html_tags", t.rlike(r"<[^>]+>")),
        ("excess_whitespace", t.rlike(f"[{tx.WS_CLASS}]{{3,}}")),
        ("very_short", F.length(t) < 50),
        ("all_caps", tx.all_caps(t)),
    ] + [(w.upper(), F.lower(t).contains(w)) for w in tx.SECTION_WORDS]
    base = df.filter(t.isNotNull())
    one = base.agg(F.count(F.lit(1)).alias("__n"),
                   *[F.sum(c.cast("long")).alias(f"__f{i}") for i, (_, c) in enumerate(flags)])
    stacked = one.select("__n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"__f{i}").alias("n_texts"))
        for i, (name, _) in enumerate(flags)])).alias("s"))
    return stacked.select(F.col("s.check").alias("check"),
                          F.coalesce(F.col("s.n_texts"), F.lit(0)).cast("long").alias("n_texts"),
                          _pct(F.coalesce(F.col("s.n_texts"), F.lit(0)), F.col("__n")).alias("pct"))


def section_counts(df: DataFrame, text_col: str = "transcription") -> DataFrame:
    return text_quality(df, text_col).filter(F.col("check").isin([w.upper() for w in tx.SECTION_WORDS]))


def _top_classes(df: DataFrame, target_col: str, k: int) -> DataFrame:
    """The k largest classes (ties by name) with their rank; at most k rows, safe to broadcast."""
    return (df.groupBy(F.col(target_col).alias("class")).agg(F.count(F.lit(1)).alias("n_docs"))
            .filter(F.col("class").isNotNull())
            .orderBy(F.desc("n_docs"), F.asc("class")).limit(k)
            .select("class", "n_docs"))


def _class_words(df: DataFrame, text_col: str, target_col: str, k: int) -> DataFrame:
    top = _top_classes(df, target_col, k)
    return (df.filter(F.col(text_col).isNotNull())
            .join(F.broadcast(top), df[target_col] == top["class"], "left_semi")
            .select(F.col(target_col).alias("class"),
                    F.explode_outer(tx.whitespace_words(F.col(text_col))).alias("word"))
            .filter(F.col("word").isNotNull()))


def vocab_richness(df: DataFrame, text_col: str, target_col: str, top_k: int = 5) -> DataFrame:
    """Total words, unique words and their ratio for the top-k classes."""
    words = _class_words(df, text_col, target_col, top_k)
    per_word = words.groupBy("class", "word").agg(F.count(F.lit(1)).alias("c"))
    return per_word.groupBy("class").agg(
        F.sum("c").cast("long").alias("total_words"),
        F.count(F.lit(1)).alias("unique_words")).select(
        "class", "total_words", "unique_words",
        F.round(F.col("unique_words") / F.col("total_words"), 6).alias("richness_ratio"))


def vocab_overlap(df: DataFrame, text_col: str, target_col: str) -> DataFrame:
    """Vocabulary overlap of the two largest classes, in one ``groupBy(word)``."""
    top = _top_classes(df, target_col, 2)
    first = top.orderBy(F.desc("n_docs"), F.asc("class")).limit(1).select("class").scalar()
    words = _class_words(df, text_col, target_col, 2)
    per_word = words.groupBy("word").agg(
        F.max((F.col("class") == first).cast("int")).alias("in1"),
        F.max((F.col("class") != first).cast("int")).alias("in2"))
    meaningful = (F.length("word") > 3) & ~F.col("word").isin(OVERLAP_COMMON_WORDS)
    return per_word.agg(
        F.sum(F.col("in1") * F.col("in2")).cast("long").alias("shared_words"),
        F.count(F.lit(1)).alias("union_words"),
        F.sum(((F.col("in1") == 1) & (F.col("in2") == 0)).cast("long")).alias("only_first"),
        F.sum(((F.col("in1") == 0) & (F.col("in2") == 1)).cast("long")).alias("only_second"),
        F.sum(((F.col("in1") == 1) & (F.col("in2") == 0) & meaningful).cast("long"))
        .alias("only_first_meaningful"),
        F.sum(((F.col("in1") == 0) & (F.col("in2") == 1) & meaningful).cast("long"))
        .alias("only_second_meaningful"),
    ).select("*", F.round(F.lit(100.0) * F.col("shared_words") / F.col("union_words"), 6)
             .alias("overlap_pct"))


def class_top_terms(df: DataFrame, text_col: str, target_col: str,
                    top_classes: int = 5, top_terms: int = 10,
                    stop_words=TOP_TERM_STOP_WORDS) -> DataFrame:
    """Top terms (length > 3, not stop words) per class of the largest classes.

    Word counts are a ``groupBy(class, word)`` with map-side partial
    aggregation; the per-class top-k is a window over the (class, word)
    counts, so a large class is never collected into one row.
    """
    words = _class_words(df, text_col, target_col, top_classes)
    words = words.filter((F.length("word") > 3) & ~F.col("word").isin(list(stop_words)))
    counts = words.groupBy("class", "word").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("class").orderBy(F.desc("n"), F.asc("word"))
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_terms)
    per_class = (df.filter(F.col(target_col).isNotNull())
                 .groupBy(F.col(target_col).alias("class"))
                 .agg(F.count(F.lit(1)).alias("n_docs"),
                      F.round(F.avg(F.length(text_col)), 6).alias("avg_chars")))
    return ranked.join(per_class, "class", "inner").select(
        "class", "rank", "word", F.col("n").cast("long").alias("n"), "n_docs", "avg_chars")


def feature_availability(df: DataFrame, known=("description", "transcription", "sample_name",
                                               "keywords")) -> DataFrame:
    """Which known feature columns exist; keywords usable if < 50% missing."""
    n = df.select(F.count(F.lit(1))).scalar()
    spark = df.sparkSession
    rows = [(c, c in df.columns) for c in known]
    out = spark.createDataFrame(rows, "column_name string, present boolean")
    if "keywords" in df.columns:
        miss = df.select(F.sum(F.col("keywords").isNull().cast("long"))).scalar()
        pct = F.lit(100.0) * miss / n
        usable = F.when(F.col("column_name") == "keywords", pct < 50).otherwise(F.col("present"))
        miss_pct = F.when(F.col("column_name") == "keywords", F.round(pct, 6))
    else:
        usable = F.when(F.col("column_name") == "keywords", F.lit(False)).otherwise(F.col("present"))
        miss_pct = F.lit(None).cast("double")
    return out.select("column_name", "present", usable.alias("usable"),
                      miss_pct.alias("missing_pct"))


def eda_summary(df: DataFrame, text_col: str, target_col: str, top_tier: int = 100) -> DataFrame:
    """Classes, average characters, share of rows in classes with >= top_tier rows."""
    counts = class_counts(df.filter(F.col(target_col).isNotNull()), target_col)
    tier_rows = counts.select(F.coalesce(F.sum(F.when(F.col("n") >= top_tier, F.col("n"))),
                                         F.lit(0))).scalar()
    return df.agg(
        F.countDistinct(target_col).alias("classes"),
        F.round(F.avg(F.length(text_col)), 6).alias("avg_chars"),
        F.count(F.lit(1)).alias("n_rows"),
    ).select("classes", "avg_chars",
             F.round(F.lit(100.0) * tier_rows / F.col("n_rows"), 6).alias("top_tier_pct"))


def data_quality_gate(df: DataFrame, text_col: str, target_col: str,
                      max_missing_pct: float = 5.0, min_avg_length: float = 50.0) -> DataFrame:
    """Totals, missing text/label, average length, distinct labels, status and warnings."""
    one = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.col(text_col).isNull().cast("long")).alias("missing_text"),
        F.sum(F.col(target_col).isNull().cast("long")).alias("missing_labels"),
        F.round(F.avg(F.length(text_col)), 6).alias("avg_text_length"),
        F.countDistinct(target_col).alias("unique_labels"))
    miss_pct = F.lit(100.0) * F.col("missing_text") / F.col("total_records")
    warn_missing = miss_pct > max_missing_pct
    warn_short = F.col("avg_text_length") < min_avg_length
    status = (F.when(F.col("total_records") == 0, F.lit("no_data"))
              .when(warn_missing | warn_short, F.lit("warning")).otherwise(F.lit("passed")))
    return one.select(
        F.col("total_records").cast("long").alias("total_records"),
        F.coalesce("missing_text", F.lit(0)).cast("long").alias("missing_text"),
        F.coalesce("missing_labels", F.lit(0)).cast("long").alias("missing_labels"),
        "avg_text_length", F.col("unique_labels").cast("long").alias("unique_labels"),
        F.coalesce(warn_missing, F.lit(False)).alias("warn_missing"),
        F.coalesce(warn_short, F.lit(False)).alias("warn_short"),
        status.alias("status"))


def artifact_scan(df: DataFrame, text_col: str = "transcription", id_col: str = "doc_id",
                  sample_size: int | None = None) -> DataFrame:
    """Matches of each artifact pattern: total matches and texts with a hit.

    ``sample_size`` restricts the scan to the first texts by id (the
    reference looks at a sample); the default scans the whole table in one
    aggregate pass.
    """
    base = df.filter(F.col(text_col).isNotNull())
    if sample_size:
        base = base.orderBy(id_col).limit(sample_size)
    names = list(tx.ARTIFACT_PATTERNS)
    hits = base.select(*[tx.artifact_hits(F.col(text_col), n).alias(f"__h{i}")
                         for i, n in enumerate(names)])
    one = hits.agg(*[F.sum(f"__h{i}").alias(f"__m{i}") for i in range(len(names))],
                   *[F.sum((F.col(f"__h{i}") > 0).cast("long")).alias(f"__t{i}")
                     for i in range(len(names))])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("pattern"),
                 F.coalesce(F.col(f"__m{i}"), F.lit(0)).cast("long").alias("matches"),
                 F.coalesce(F.col(f"__t{i}"), F.lit(0)).cast("long").alias("texts_with_hits"))
        for i, n in enumerate(names)])).alias("s")).select("s.*")


def artifact_examples(df: DataFrame, text_col: str = "transcription", most: int = 5) -> DataFrame:
    """``(pattern, rank, example, texts)``: up to ``most`` distinct matches of each artifact pattern, most frequent first.

    Matches are counted per (pattern, match) before they are ranked; one pattern's ranking keeps ``most`` rows in every task.
    """
    found = [F.struct(F.lit(n).alias("pattern"), F.array_distinct(tx.artifact_matches(F.col(text_col), n)).alias("m")) for n in tx.ARTIFACT_PATTERNS]
    each = df.select(F.explode(F.array(*found)).alias("f")).select("f.pattern", F.explode("f.m").alias("example"))
    order = Window.partitionBy("pattern").orderBy(F.desc("texts"), "example")
    counts = each.groupBy("pattern", "example").agg(F.count(F.lit(1)).alias("texts"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("pattern", "rank", "example", "texts")


def _artifact_flags(df: DataFrame, text_col: str, has=tx.has_artifact) -> DataFrame:
    # No IS NOT NULL filter here: pushed below the projection it would copy
    # the whole text-cleaning expression into the filter (has_artifact
    # already treats null as empty).
    return df.agg(*[F.coalesce(F.max(has(F.col(text_col), pattern)), F.lit(False)).alias(name)
                    for name, pattern in (("dates", "date_labels"), ("phones", "phone_numbers"))])


def artifact_flags(df: DataFrame, text_col: str = "transcription", has=tx.has_artifact) -> tuple[bool, bool]:
    """``artifact_switches`` found at once: texts that are normalised later skip what is switched off."""
    return tuple(_artifact_flags(df, text_col, has).first())


def artifact_switches(df: DataFrame, text_col: str = "transcription"):
    """(remove_date_labels, remove_phones) as boolean Columns over one scalar
    subquery: true when the corpus has any date-label / phone hit.  Lazy: no
    driver round trip, one pass for both switches."""
    one = _artifact_flags(df, text_col).select(F.struct("*")).scalar()
    return one["dates"], one["phones"]
