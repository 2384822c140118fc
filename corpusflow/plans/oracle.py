"""DuckDB SQL twins of the registered queries (same keys, same column names).

Each string runs on DuckDB with the input tables registered as views.  They
are written independently of the Spark code path (SQL over the raw tables) so
the pair checks the Spark operators end to end.
"""
from __future__ import annotations

from corpusflow.functions import text as tx
from corpusflow.operators import profile as pr
from corpusflow.plans import sqltext as S

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


PCT = "round(100.0::DOUBLE * {x} / {n}, 6)"


def pct(x: str, n: str) -> str:
    return PCT.format(x=x, n=n)


CLEAN = S.clean_docs()
CAPPED = S.clean_docs(method="cap")
WC = S.word_count("transcription")

oracle("table_profile", """
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
                      WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE lower(data_type) END
         AS data_type,
       (SELECT count(*) FROM documents) AS n_rows
FROM information_schema.columns WHERE table_name = 'documents'
""")

oracle("clean_missing", f"""WITH {S.RAW_DOCS}
SELECT doc_id, description, medical_specialty, sample_name, transcription
FROM raw_docs WHERE transcription IS NOT NULL""")

oracle("filter_short", f"""WITH {S.RAW_DOCS}
SELECT doc_id, CAST(length(transcription) AS INTEGER) AS chars FROM raw_docs
WHERE length(transcription) >= 50""")

oracle("outlier_cap", f"""WITH {S.RAW_DOCS}, c AS (
  SELECT doc_id, CASE WHEN length(transcription) > 8000 THEN substr(transcription, 1, 8000)
                      ELSE transcription END AS t FROM raw_docs)
SELECT doc_id, CAST(length(t) AS INTEGER) AS chars, substr(sha256(t), 1, 16) AS text_hash FROM c""")

oracle("outlier_remove", f"""WITH {S.RAW_DOCS}
SELECT doc_id, CAST(length(transcription) AS INTEGER) AS chars FROM raw_docs
WHERE length(transcription) <= 8000""")

_strip = f"trim(regexp_replace(text, {S.q('^[' + tx.WS_CLASS + ']+|[' + tx.WS_CLASS + ']+$')}, '', 'g'))"
oracle("valid_text", f"""
SELECT conv_id, turn,
       CAST(CASE WHEN coalesce({_strip}, '') = '' THEN -1 ELSE length({_strip}) END AS INTEGER) AS chars
FROM conversations""")

oracle("coerce_numeric", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k,
       coalesce(TRY_CAST(event_type AS DOUBLE), 0.0) AS event_type
FROM events""")

oracle("clean_text", f"""WITH c AS (SELECT doc_id, {S.clean_text('text')} AS t FROM documents)
SELECT doc_id, CAST(length(t) AS INTEGER) AS chars, substr(sha256(t), 1, 16) AS text_hash FROM c""")

oracle("clean_text_effect", f"""WITH {S.RAW_DOCS}, k AS (
  SELECT transcription FROM raw_docs WHERE length(transcription) >= 50)
SELECT (SELECT count(*) FROM raw_docs) AS n_before, count(*) AS n_after,
       (SELECT count(*) FROM raw_docs) - count(*) AS short_removed,
       CAST(coalesce(sum(CASE WHEN {S.has_non_ascii('transcription')} THEN 1 ELSE 0 END), 0) AS BIGINT)
         AS non_ascii_before,
       CAST(coalesce(sum(CASE WHEN {S.has_non_ascii(S.clean_text('transcription'))} THEN 1 ELSE 0 END), 0)
         AS BIGINT) AS non_ascii_after
FROM k""")


def _top_n(col: str) -> str:
    return f"""(SELECT {col} AS class, count(*) AS n,
        {pct('count(*)', '(SELECT count(*) FROM raw_docs)')} AS pct
      FROM raw_docs GROUP BY 1 ORDER BY n DESC, class ASC NULLS LAST LIMIT 10)"""


oracle("class_top_n", f"""WITH {S.RAW_DOCS}
SELECT * FROM {_top_n('lang')} UNION ALL SELECT * FROM {_top_n('medical_specialty')}""")

_cols = ["doc_id", "description", "medical_specialty", "sample_name", "transcription", "keywords", "lang"]
oracle("null_profile", f"""WITH {S.RAW_DOCS}, one AS (
  SELECT count(*) AS n, {', '.join(f'count(*) - count({c}) AS n_{c}' for c in _cols)} FROM raw_docs)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(n_{c} AS BIGINT) AS null_count, {pct(f'n_{c}', 'n')} AS null_pct FROM one"
    for c in _cols))

oracle("duplicate_rows", """WITH g AS (SELECT text, lang, source, count(*) AS c FROM documents GROUP BY ALL)
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows,
       CAST(coalesce(sum(c), 0) AS BIGINT) AS n_rows FROM g""")

oracle("class_tiers", f"""WITH {S.RAW_DOCS},
counts AS (SELECT medical_specialty, count(*) AS n FROM raw_docs WHERE medical_specialty IS NOT NULL GROUP BY 1),
t AS (SELECT CASE WHEN n >= 100 THEN 'tier_1' WHEN n >= 20 AND n < 100 THEN 'tier_2'
                  WHEN n >= 5 AND n < 20 THEN 'tier_3' WHEN n < 5 THEN 'tier_rare' END AS tier, n FROM counts),
a AS (SELECT tier, count(*) AS classes, sum(n) AS samples FROM t GROUP BY 1),
tiers(tier, min_count, max_count) AS (VALUES ('tier_1', 100, NULL), ('tier_2', 20, 99),
                                             ('tier_3', 5, 19), ('tier_rare', 0, 4))
SELECT tiers.tier, CAST(min_count AS INTEGER) AS min_count, CAST(max_count AS INTEGER) AS max_count,
       CAST(coalesce(classes, 0) AS BIGINT) AS classes, CAST(coalesce(samples, 0) AS BIGINT) AS samples,
       {pct('coalesce(samples, 0)', '(SELECT count(*) FROM raw_docs)')} AS pct
FROM tiers LEFT JOIN a ON tiers.tier = a.tier""")


def _len_stats(col: str) -> str:
    wc = S.word_count(col)
    return f"""SELECT '{col}' AS column_name, round(avg(length({col})), 6) AS char_mean,
      round(quantile_cont(length({col}), 0.5), 6) AS char_median,
      round(avg({wc}), 6) AS word_mean, round(quantile_cont({wc}, 0.5), 6) AS word_median,
      CAST(min(length({col})) AS BIGINT) AS char_min, CAST(max(length({col})) AS BIGINT) AS char_max
    FROM raw_docs WHERE {col} IS NOT NULL"""


oracle("text_length_stats", f"""WITH {S.RAW_DOCS}
{_len_stats('description')} UNION ALL {_len_stats('transcription')}""")

oracle("iqr_outliers", f"""WITH {S.RAW_DOCS},
b AS (SELECT length(transcription) AS chars, {WC} AS words FROM raw_docs WHERE transcription IS NOT NULL),
q AS (SELECT count(*) AS n, quantile_cont(chars, 0.25) AS cq1, quantile_cont(chars, 0.75) AS cq3,
             quantile_cont(words, 0.25) AS wq1, quantile_cont(words, 0.75) AS wq3,
             quantile_cont(chars, 0.5) AS cmed, max(chars) AS cmax FROM b),
bd AS (SELECT *, cq1 - 1.5 * (cq3 - cq1) AS c_lo, cq3 + 1.5 * (cq3 - cq1) AS c_hi,
              wq1 - 1.5 * (wq3 - wq1) AS w_lo, wq3 + 1.5 * (wq3 - wq1) AS w_hi FROM q),
c AS (SELECT CAST(coalesce(sum(CASE WHEN chars < c_lo THEN 1 ELSE 0 END), 0) AS BIGINT) AS char_outliers_low,
             CAST(coalesce(sum(CASE WHEN chars > c_hi THEN 1 ELSE 0 END), 0) AS BIGINT) AS char_outliers_high,
             CAST(coalesce(sum(CASE WHEN words < w_lo THEN 1 ELSE 0 END), 0) AS BIGINT) AS word_outliers_low,
             CAST(coalesce(sum(CASE WHEN words > w_hi THEN 1 ELSE 0 END), 0) AS BIGINT) AS word_outliers_high
      FROM b, bd)
SELECT n, round(c_lo, 6) AS char_lower, round(c_hi, 6) AS char_upper,
       round(w_lo, 6) AS word_lower, round(w_hi, 6) AS word_upper,
       char_outliers_low, char_outliers_high, word_outliers_low, word_outliers_high,
       round(100.0::DOUBLE * (char_outliers_low + char_outliers_high) / n, 6) AS outlier_pct,
       char_outliers_high > n * 0.01 AS warn_many_long, char_outliers_low > n * 0.01 AS warn_many_short,
       cmax > cmed * 10 AS warn_extreme_max
FROM bd, c""")

oracle("text_extremes", f"""WITH {S.RAW_DOCS},
b AS (SELECT doc_id AS id, CAST(length(transcription) AS BIGINT) AS chars, medical_specialty AS class
      FROM raw_docs WHERE transcription IS NOT NULL)
(SELECT 'longest' AS kind, id, chars, class FROM b ORDER BY chars DESC, id ASC LIMIT 1)
UNION ALL
(SELECT 'shortest' AS kind, id, chars, class FROM b ORDER BY chars ASC, id ASC LIMIT 1)""")

_T = "transcription"
_flags = [
    ("non_ascii", S.has_non_ascii(_T)),
    ("html_tags", f"regexp_matches({_T}, '<[^>]+>')"),
    ("excess_whitespace", f"regexp_matches({_T}, {S.q('[' + tx.WS_CLASS + ']{3,}')})"),
    ("very_short", f"length({_T}) < 50"),
    ("all_caps", S.all_caps(_T)),
] + [(w.upper(), f"contains(lower({_T}), '{w}')") for w in tx.SECTION_WORDS]


def _quality_sql(names=None) -> str:
    fl = [(n, e) for n, e in _flags if names is None or n in names]
    one = ", ".join(f"sum(CASE WHEN {e} THEN 1 ELSE 0 END) AS f{i}" for i, (_, e) in enumerate(fl))
    parts = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"check\", CAST(coalesce(f{i}, 0) AS BIGINT) AS n_texts, "
        f"{pct(f'coalesce(f{i}, 0)', 'n')} AS pct FROM one" for i, (n, _) in enumerate(fl))
    return f"""WITH {S.RAW_DOCS}, one AS (SELECT count(*) AS n, {one} FROM raw_docs WHERE {_T} IS NOT NULL)
{parts}"""


oracle("text_quality", _quality_sql())
oracle("section_counts", _quality_sql([w.upper() for w in tx.SECTION_WORDS]))


def _class_words(target: str, k: int) -> str:
    return f"""top_c AS (SELECT {target} AS class, count(*) AS n_docs FROM clean_docs
                 WHERE {target} IS NOT NULL GROUP BY 1 ORDER BY n_docs DESC, class ASC LIMIT {k}),
  cw AS (SELECT d.{target} AS class, unnest({S.whitespace_words('d.transcription')}) AS word
         FROM clean_docs d SEMI JOIN top_c ON d.{target} = top_c.class
         WHERE d.transcription IS NOT NULL)"""


oracle("vocab_richness", f"""WITH {CLEAN}, {_class_words('medical_specialty', 5)},
pw AS (SELECT class, word, count(*) AS c FROM cw GROUP BY ALL)
SELECT class, CAST(sum(c) AS BIGINT) AS total_words, count(*) AS unique_words,
       round(count(*) / sum(c), 6) AS richness_ratio FROM pw GROUP BY class""")

_common = S.str_list(pr.OVERLAP_COMMON_WORDS)
oracle("vocab_overlap", f"""WITH {CLEAN}, {_class_words('lang', 2)},
first_c AS (SELECT class FROM top_c ORDER BY n_docs DESC, class ASC LIMIT 1),
pw AS (SELECT word, max(CASE WHEN class = (SELECT class FROM first_c) THEN 1 ELSE 0 END) AS in1,
              max(CASE WHEN class <> (SELECT class FROM first_c) THEN 1 ELSE 0 END) AS in2
       FROM cw GROUP BY word),
m AS (SELECT *, length(word) > 3 AND NOT list_contains({_common}, word) AS meaningful FROM pw)
SELECT CAST(sum(in1 * in2) AS BIGINT) AS shared_words, count(*) AS union_words,
       CAST(sum(CASE WHEN in1 = 1 AND in2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS only_first,
       CAST(sum(CASE WHEN in1 = 0 AND in2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS only_second,
       CAST(sum(CASE WHEN in1 = 1 AND in2 = 0 AND meaningful THEN 1 ELSE 0 END) AS BIGINT) AS only_first_meaningful,
       CAST(sum(CASE WHEN in1 = 0 AND in2 = 1 AND meaningful THEN 1 ELSE 0 END) AS BIGINT) AS only_second_meaningful,
       round(100.0::DOUBLE * sum(in1 * in2) / count(*), 6) AS overlap_pct
FROM m""")

_stops = S.str_list(pr.TOP_TERM_STOP_WORDS)
oracle("class_top_terms", f"""WITH {CLEAN}, {_class_words('medical_specialty', 5)},
f AS (SELECT * FROM cw WHERE length(word) > 3 AND NOT list_contains({_stops}, word)),
c AS (SELECT class, word, count(*) AS n FROM f GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY n DESC, word ASC) AS rank FROM c),
pc AS (SELECT medical_specialty AS class, count(*) AS n_docs,
              round(avg(length(transcription)), 6) AS avg_chars
       FROM clean_docs WHERE medical_specialty IS NOT NULL GROUP BY 1)
SELECT r.class, CAST(rank AS INTEGER) AS rank, word, CAST(n AS BIGINT) AS n, n_docs, avg_chars
FROM r JOIN pc ON r.class = pc.class WHERE rank <= 10""")

oracle("feature_availability", f"""WITH {S.RAW_DOCS},
m AS (SELECT 100.0::DOUBLE * (count(*) - count(keywords)) / count(*) AS p FROM raw_docs),
k(column_name, present) AS (VALUES ('description', true), ('transcription', true),
                                   ('sample_name', true), ('keywords', true))
SELECT column_name, present,
       CASE WHEN column_name = 'keywords' THEN (SELECT p FROM m) < 50 ELSE present END AS usable,
       CASE WHEN column_name = 'keywords' THEN round((SELECT p FROM m), 6) END AS missing_pct
FROM k""")

oracle("eda_summary", f"""WITH {S.RAW_DOCS},
c AS (SELECT lang, count(*) AS n FROM raw_docs WHERE lang IS NOT NULL GROUP BY 1)
SELECT count(DISTINCT lang) AS classes, round(avg(length(transcription)), 6) AS avg_chars,
       round(100.0::DOUBLE * (SELECT coalesce(sum(CASE WHEN n >= 100 THEN n END), 0) FROM c) / count(*), 6)
         AS top_tier_pct
FROM raw_docs""")

oracle("data_quality_gate", f"""WITH {S.RAW_DOCS},
o AS (SELECT count(*) AS total_records, count(*) - count(transcription) AS missing_text,
             count(*) - count(medical_specialty) AS missing_labels,
             round(avg(length(transcription)), 6) AS avg_text_length,
             count(DISTINCT medical_specialty) AS unique_labels FROM raw_docs)
SELECT CAST(total_records AS BIGINT) AS total_records, CAST(missing_text AS BIGINT) AS missing_text,
       CAST(missing_labels AS BIGINT) AS missing_labels, avg_text_length,
       CAST(unique_labels AS BIGINT) AS unique_labels,
       coalesce(100.0::DOUBLE * missing_text / total_records > 5.0, false) AS warn_missing,
       coalesce(avg_text_length < 50.0, false) AS warn_short,
       CASE WHEN total_records = 0 THEN 'no_data'
            WHEN 100.0::DOUBLE * missing_text / total_records > 5.0 OR avg_text_length < 50.0 THEN 'warning'
            ELSE 'passed' END AS status
FROM o""")

oracle("reduce_classes", f"""WITH {S.RAW_DOCS},
k AS (SELECT * FROM raw_docs WHERE length(transcription) >= 50),
top AS (SELECT medical_specialty AS c FROM k WHERE medical_specialty IS NOT NULL GROUP BY 1
        ORDER BY count(*) DESC, 1 LIMIT 15),
r AS (SELECT CASE WHEN top.c IS NOT NULL THEN k.medical_specialty ELSE 'Other' END AS class
      FROM k LEFT JOIN top ON k.medical_specialty = top.c)
SELECT class, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM r)')} AS pct FROM r GROUP BY 1""")

oracle("clean_pipeline", f"""WITH {CAPPED}
SELECT doc_id, medical_specialty, CAST(length(transcription) AS INTEGER) AS chars,
       substr(sha256(transcription), 1, 16) AS text_hash FROM clean_docs""")

oracle("clean_summary", f"""WITH {CAPPED},
b AS (SELECT count(*) AS rows_before, count(DISTINCT medical_specialty) AS classes_before FROM raw_docs)
SELECT rows_before, count(*) AS rows_after, rows_before - count(*) AS rows_removed,
       round(100.0::DOUBLE * (rows_before - count(*)) / rows_before, 6) AS removed_pct,
       classes_before, count(DISTINCT medical_specialty) AS classes_after,
       CAST(min(length(transcription)) AS BIGINT) AS min_chars,
       CAST(max(length(transcription)) AS BIGINT) AS max_chars,
       round(avg(length(transcription)), 6) AS avg_chars
FROM clean_docs, b GROUP BY rows_before, classes_before""")


# --- text normalisation ----------------------------------------------------------

def _norm_sql(expr: str, src: str = "clean_docs", id_col: str = "doc_id", ctes: str = CLEAN) -> str:
    return f"""WITH {ctes}, n AS (SELECT {id_col}, {expr} AS t FROM {src})
SELECT {id_col}, CAST(length(t) AS INTEGER) AS chars, substr(sha256(t), 1, 16) AS text_hash FROM n"""


def _matches(e: str, name: str) -> str:
    return f"regexp_extract_all(lower(coalesce({e}, '')), {S.q('(?i)' + tx.ARTIFACT_PATTERNS[name])}, 0)"


def _hits(e: str, name: str) -> str:
    return f"len({_matches(e, name)})"


_sw = f"""sw AS (SELECT coalesce(max({_hits('transcription', 'date_labels')} > 0), false) AS dates,
                  coalesce(max({_hits('transcription', 'phone_numbers')} > 0), false) AS phones
           FROM clean_docs WHERE transcription IS NOT NULL)"""
_nc_expr = ("CASE WHEN sw.dates AND sw.phones THEN "
            + S.normalize_conservative("transcription", True, True)
            + " WHEN sw.dates THEN " + S.normalize_conservative("transcription", True, False)
            + " WHEN sw.phones THEN " + S.normalize_conservative("transcription", False, True)
            + " ELSE " + S.normalize_conservative("transcription") + " END")
oracle("normalize_conservative", _norm_sql(_nc_expr, "clean_docs, sw", ctes=CLEAN + ", " + _sw))
oracle("normalize_aggressive", _norm_sql(S.normalize_aggressive("transcription")))
oracle("strip_punct", _norm_sql(S.strip_punct(S.clean_text("lower(html)")), "pages", "page_id", "x AS (SELECT 1)"))
oracle("normalize_simple", _norm_sql(S.normalize_simple("transcription")))


def _scan_sql(src: str, name: str, label: str) -> str:
    names = list(tx.ARTIFACT_PATTERNS)
    h = ", ".join(f"{_hits('t', n)} AS h{i}" for i, n in enumerate(names))
    parts = " UNION ALL ".join(
        f"SELECT '{label}' AS src, '{n}' AS pattern, CAST(coalesce(sum(h{i}), 0) AS BIGINT) AS matches, "
        f"CAST(coalesce(sum(CASE WHEN h{i} > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS texts_with_hits FROM {name}_h"
        for i, n in enumerate(names))
    return f"{name}_h AS (SELECT {h} FROM ({src}) WHERE t IS NOT NULL)", parts


_d_cte, _d_sel = _scan_sql("SELECT transcription AS t FROM clean_docs", "d", "documents")
_p_cte, _p_sel = _scan_sql(f"SELECT {S.clean_text('html')} AS t FROM pages", "p", "pages")
_examples = " UNION ALL ".join(f"SELECT '{n}' AS pattern, unnest(list_distinct({_matches('t', n)})) AS example FROM pg" for n in tx.ARTIFACT_PATTERNS)
oracle("artifact_examples", f"""WITH pg AS (SELECT {S.clean_text('html')} AS t FROM pages),
c AS (SELECT pattern, example, count(*) AS texts FROM ({_examples}) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY texts DESC, example) AS rank FROM c)
SELECT pattern, CAST(rank AS INTEGER) AS rank, example, texts FROM r WHERE rank <= 5""")
oracle("artifact_scan", f"WITH {CLEAN}, {_d_cte}, {_p_cte}\n{_d_sel} UNION ALL {_p_sel}")

oracle("combined_text", _norm_sql(
    f"trim(coalesce({S.normalize_conservative('description')}, '') || ' ' || "
    f"coalesce({S.normalize_conservative('transcription')}, ''))"))

_tc, _dc = "CAST(coalesce(length(transcription), 0) AS BIGINT)", "CAST(coalesce(length(description), 0) AS BIGINT)"
oracle("length_features", f"""WITH {CLEAN}
SELECT doc_id, {_tc} AS transcription_char_length, {S.word_count('transcription')} AS transcription_word_count,
       {_dc} AS description_char_length, {S.word_count('description')} AS description_word_count,
       round({_tc} / ({_dc} + 1), 6) AS text_length_ratio FROM clean_docs""")

oracle("length_category", f"""SELECT doc_id, {S.length_category_label('length(text)')} AS text_length_category,
       {S.length_category_code('length(text)')} AS text_length_code FROM documents""")

oracle("section_flags", "SELECT page_id, " + ", ".join(
    f"CAST(coalesce(contains(lower(html), '{w}'), false) AS INTEGER) AS has_{w}" for w in tx.SECTION_WORDS)
    + " FROM pages")

oracle("input_hash", """SELECT doc_id, substr(sha256(text), 1, 16) AS input_hash,
       CAST(length(substr(text, 1, 500)) AS INTEGER) AS input_length FROM documents""")

oracle("request_id", """SELECT event_id,
       substr(md5(strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || substr(props, 1, 50)), 1, 12) AS request_id
FROM events""")

_ws = S.q("[^\\p{L}\\p{N}" + tx.WS_CLASS + "]")
oracle("text_stats", f"""WITH b AS (SELECT conv_id, turn, coalesce(text, '') AS c FROM conversations),
s AS (SELECT conv_id, turn, c, length(c) AS n, {S.collapse_ws('c')} AS cw FROM b),
w AS (SELECT *, CASE WHEN cw = '' THEN []::VARCHAR[] ELSE string_split(cw, ' ') END AS words FROM s)
SELECT conv_id, turn, CAST(n AS BIGINT) AS text_length, CAST(len(words) AS BIGINT) AS word_count,
  round(CASE WHEN len(words) > 0 THEN list_sum(list_transform(words, lambda x: length(x))) / len(words)
        ELSE 0.0 END, 6) AS avg_word_length,
  round(CASE WHEN n > 0 THEN len(list_distinct(regexp_extract_all(lower(c), '(?s).', 0))) / n ELSE 0.0 END, 6)
    AS char_diversity,
  round(CASE WHEN n > 0 THEN (n - length(regexp_replace(c, '\\p{{Lu}}', '', 'g'))) / n ELSE 0.0 END, 6)
    AS uppercase_ratio,
  round(CASE WHEN n > 0 THEN (n - length(regexp_replace(c, '\\p{{Nd}}', '', 'g'))) / n ELSE 0.0 END, 6)
    AS digit_ratio,
  round(CASE WHEN n > 0 THEN (n - length(regexp_replace(c, {_ws}, '', 'g'))) / n ELSE 0.0 END, 6)
    AS punctuation_ratio
FROM w""")

oracle("vector_stats", """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT vec_id, round(list_avg(e), 6) AS mean, round(list_aggregate(e, 'stddev_pop'), 6) AS std,
       list_min(e) AS min, list_max(e) AS max,
       round(len(list_filter(e, lambda x: x = 0)) / len(e), 6) AS zero_fraction
FROM e""")

# --- monitoring ----------------------------------------------------------------------

REQ = """requests AS (
  SELECT event_id, ts,
         ['/predict', '/health', '/monitoring/metrics', '/'][(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4) + 1]
           AS endpoint,
         CAST(CASE WHEN event_type = 'error' THEN [500, 404, 503][(event_id % 3) + 1] ELSE 200 END AS INTEGER)
           AS status_code,
         value AS response_time_ms, CAST(user_id AS VARCHAR) AS user_agent
  FROM events)"""
PRED = """predictions AS (
  SELECT event_id AS seq, ts, 'v1' AS model_version, event_type AS prediction,
         1.0::DOUBLE / (1.0::DOUBLE + value / 100.0::DOUBLE) AS confidence,
         0.3::DOUBLE * value AS preprocessing_time_ms, 0.7::DOUBLE * value AS prediction_time_ms,
         value AS total_time_ms
  FROM events)"""
ERRC = "CASE WHEN status_code >= 400 THEN 1 ELSE 0 END"


def fp(lst: str, n: str, p: float) -> str:
    """Floor nearest-rank percentile from a sorted list (DuckDB)."""
    return f"{lst}[CAST(floor({p}::DOUBLE * ({n} - 1)) AS INTEGER) + 1]"


KPIS = REQ + f""",
kt AS (SELECT max(ts) AS as_of, min(ts) AS first_ts, count(*) AS total_requests,
              sum({ERRC}) AS total_errors FROM requests),
recent AS (SELECT r.* FROM requests r, kt WHERE r.ts > kt.as_of - INTERVAL 60 MINUTE AND r.ts <= kt.as_of),
ka AS (SELECT count(*) AS n, sum({ERRC}) AS errors, avg(response_time_ms) AS avg_rt,
              list_sort(list(response_time_ms)) AS l FROM recent),
kpis AS (
  SELECT round(n / 60.0::DOUBLE, 6) AS requests_per_minute,
         round(CASE WHEN n > 0 THEN 100.0::DOUBLE * errors / n ELSE 0.0 END, 6) AS error_rate_percent,
         round(coalesce(avg_rt, 0.0), 6) AS avg_response_time_ms,
         round(coalesce({fp('l', 'n', 0.95)}, 0.0), 6) AS p95_response_time_ms,
         round(coalesce({fp('l', 'n', 0.99)}, 0.0), 6) AS p99_response_time_ms,
         CAST(total_requests AS BIGINT) AS total_requests, CAST(coalesce(total_errors, 0) AS BIGINT) AS total_errors,
         round((epoch_us(as_of) - epoch_us(first_ts)) / 60000000.0::DOUBLE, 6) AS uptime_minutes,
         n AS window_requests
  FROM ka, kt)"""

oracle("log_parse", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n,
       round(sum(value), 6) AS sum_rt,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k
FROM events GROUP BY 1""")

oracle("slow_requests", f"WITH {REQ} SELECT event_id, endpoint, response_time_ms FROM requests "
                        "WHERE response_time_ms > 400")
oracle("low_confidence", f"WITH {PRED} SELECT seq, prediction, round(confidence, 6) AS confidence "
                         "FROM predictions WHERE confidence < 0.5")

oracle("rolling_kpis", f"""WITH {KPIS}
SELECT *, CASE WHEN error_rate_percent > 5.0 THEN 'degraded' ELSE 'operational' END AS status FROM kpis""")

_ep_p = f"""ep AS (SELECT endpoint, count(*) AS n, list_sort(list(response_time_ms)) AS l FROM requests GROUP BY 1)"""
oracle("floor_percentile", f"""WITH {REQ}, {_ep_p}
SELECT endpoint, {fp('l', 'n', 0.5)} AS p50, {fp('l', 'n', 0.95)} AS p95, {fp('l', 'n', 0.99)} AS p99 FROM ep""")

oracle("endpoint_metrics", f"""WITH {REQ}, {_ep_p},
b AS (SELECT endpoint, count(*) AS total_requests, sum({ERRC}) AS total_errors, avg(response_time_ms) AS a,
             min(response_time_ms) AS mn, max(response_time_ms) AS mx FROM requests GROUP BY 1)
SELECT b.endpoint, total_requests, CAST(total_errors AS BIGINT) AS total_errors,
       round(100.0::DOUBLE * total_errors / total_requests, 6) AS error_rate_percent,
       round(a, 6) AS avg_response_time_ms, mn AS min_response_time_ms, mx AS max_response_time_ms,
       {fp('l', 'n', 0.5)} AS p50_response_time_ms, {fp('l', 'n', 0.95)} AS p95_response_time_ms,
       {fp('l', 'n', 0.99)} AS p99_response_time_ms
FROM b JOIN ep ON b.endpoint = ep.endpoint""")

oracle("error_summary", f"""WITH {REQ}, t AS (SELECT max(ts) AS as_of FROM requests),
e AS (SELECT r.* FROM requests r, t WHERE status_code >= 400 AND r.ts > t.as_of - INTERVAL 24 HOUR
      AND r.ts <= t.as_of),
g AS (SELECT CASE GROUPING(status_code, endpoint) WHEN 1 THEN 'status_code' WHEN 2 THEN 'endpoint'
                  ELSE 'total' END AS dimension,
             CASE GROUPING(status_code, endpoint) WHEN 1 THEN CAST(status_code AS VARCHAR)
                  WHEN 2 THEN endpoint END AS key,
             count(*) AS n_errors
      FROM e GROUP BY GROUPING SETS ((status_code), (endpoint), ()))
SELECT dimension, key, n_errors,
       row_number() OVER (PARTITION BY dimension ORDER BY n_errors DESC, key ASC) = 1 AS is_most_common,
       round(n_errors / 24.0::DOUBLE, 6) AS errors_per_hour
FROM g""")

oracle("recent_errors", f"""WITH {REQ}
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, endpoint, status_code FROM requests
WHERE status_code >= 400 AND ts > (SELECT max(ts) FROM requests) - INTERVAL 24 HOUR
ORDER BY requests.ts DESC, event_id DESC LIMIT 10""")

oracle("hourly_trends", f"""WITH {REQ}, t AS (SELECT date_trunc('hour', max(ts)) AS top FROM requests),
cal AS (SELECT unnest(generate_series(top - INTERVAL 23 HOUR, top, INTERVAL 1 HOUR)) AS hour FROM t),
a AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS requests, sum({ERRC}) AS errors,
             avg(response_time_ms) AS avg_rt
      FROM requests, t WHERE ts >= top - INTERVAL 23 HOUR AND ts < top + INTERVAL 1 HOUR GROUP BY 1)
SELECT strftime(cal.hour, '%Y-%m-%d-%H') AS hour_key, CAST(coalesce(requests, 0) AS BIGINT) AS requests,
       CAST(coalesce(errors, 0) AS BIGINT) AS errors, round(coalesce(avg_rt, 0.0), 6) AS avg_response_time,
       round(CASE WHEN requests > 0 THEN 100.0::DOUBLE * errors / requests ELSE 0.0 END, 6) AS error_rate_percent
FROM cal LEFT JOIN a ON cal.hour = a.hour""")

oracle("anomalies", f"""WITH {KPIS},
rules AS (
  SELECT 'HIGH_ERROR_RATE' AS type, CASE WHEN error_rate_percent > 10.0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
         error_rate_percent AS value, 1 AS o FROM kpis WHERE error_rate_percent > 5.0
  UNION ALL
  SELECT 'HIGH_RESPONSE_TIME', CASE WHEN p95_response_time_ms > 10000 THEN 'HIGH' ELSE 'MEDIUM' END,
         p95_response_time_ms, 2 FROM kpis WHERE p95_response_time_ms > 5000
  UNION ALL
  SELECT 'LOW_REQUEST_VOLUME', 'MEDIUM', requests_per_minute, 3 FROM kpis
  WHERE requests_per_minute < 0.1 AND uptime_minutes > 10),
c AS (SELECT CAST(count(*) AS INTEGER) AS anomaly_count FROM rules)
SELECT type, severity, value, anomaly_count,
       CASE WHEN anomaly_count = 0 THEN 'HEALTHY' ELSE 'DEGRADED' END AS status
FROM c LEFT JOIN rules ON true""")

from corpusflow.operators.monitor import EXPORT_NAMES  # noqa: E402

oracle("metrics_export", f"WITH {KPIS}\n" + " UNION ALL ".join(
    f"SELECT '{dst}' AS metric, round(CAST({src} AS DOUBLE), 6) AS value FROM kpis" for src, dst in EXPORT_NAMES))

oracle("log_rejects", """SELECT CASE WHEN event_id % 13 = 0 THEN 'rejected' ELSE 'parsed' END AS outcome, count(*) AS n FROM events GROUP BY 1""")
oracle("prediction_errors", """SELECT event_id, 'v1' AS model_version, 'prediction_error' AS event_type FROM events
WHERE event_type = 'error' AND event_id % 5 <> 0""")
oracle("log_counters", f"""WITH {REQ}, {PRED}
SELECT 'status_code' AS counter, CAST(status_code AS VARCHAR) AS key, count(*) AS n FROM requests GROUP BY 2
UNION ALL SELECT 'endpoint', endpoint, count(*) FROM requests GROUP BY 2
UNION ALL SELECT 'errors', '', count(*) FROM requests WHERE status_code >= 400
UNION ALL SELECT 'model_version', model_version, count(*) FROM predictions GROUP BY 2
UNION ALL SELECT 'low_confidence', model_version, count(*) FROM predictions WHERE confidence < 0.7 GROUP BY 2""")

_ds = ("text_length", "word_count", "avg_word_length")
oracle("drift_text_stats", f"""WITH b AS (SELECT doc_id, coalesce(text, '') AS c, 1.0::DOUBLE / (1.0::DOUBLE + length(text) / 2000.0::DOUBLE) AS confidence FROM documents
  ORDER BY doc_id DESC LIMIT 100),
s AS (SELECT *, length(c) AS n, {S.collapse_ws('c')} AS cw FROM b),
w AS (SELECT *, CASE WHEN cw = '' THEN []::VARCHAR[] ELSE string_split(cw, ' ') END AS words FROM s),
t AS (SELECT confidence, n AS text_length, len(words) AS word_count,
             CASE WHEN len(words) > 0 THEN list_sum(list_transform(words, lambda x: length(x))) / len(words) ELSE 0.0 END AS avg_word_length FROM w),
a AS (SELECT avg(confidence) AS m, stddev_pop(confidence) AS sd, avg(CASE WHEN confidence < 0.7 THEN 1.0 ELSE 0.0 END) AS low,
             {', '.join(f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in _ds)} FROM t)
SELECT 'analyzed' AS status, 100 AS window_size, round(m, 6) AS confidence_mean, round(sd, 6) AS confidence_std, round(low, 6) AS low_confidence_ratio,
       {', '.join(f"round({c}_{k}, 6) AS {c}_{k}" for c in _ds for k in ('mean', 'std'))},
       concat_ws(',', CASE WHEN low > 0.3 THEN 'HIGH_LOW_CONFIDENCE_RATIO' END, CASE WHEN sd > 0.25 THEN 'HIGH_CONFIDENCE_VARIANCE' END) AS drift_alerts FROM a""")

PERF = f"""WITH {PRED}
SELECT model_version, count(*) AS total_predictions, round(avg(preprocessing_time_ms), 6) AS avg_preprocessing_time,
       round(avg(prediction_time_ms), 6) AS avg_prediction_time, round(avg(confidence), 6) AS avg_confidence
FROM predictions GROUP BY 1"""
oracle("prediction_perf", f"""SELECT *, (SELECT count(*) FROM events WHERE event_type = 'error' AND event_id % 5 <> 0) AS error_count FROM ({PERF})""")
_LAST100 = f"""{PRED}, buf AS (SELECT * FROM predictions ORDER BY ts DESC, seq DESC LIMIT 1000),
last100 AS (SELECT * FROM buf ORDER BY ts DESC, seq DESC LIMIT 100)"""
oracle("drift_report", f"""WITH {_LAST100},
a AS (SELECT avg(confidence) AS m, stddev_pop(confidence) AS s,
             avg(CASE WHEN confidence < 0.7 THEN 1.0 ELSE 0.0 END) AS low FROM last100),
n AS (SELECT least(count(*), 1000) AS n_all FROM predictions)
SELECT CASE WHEN n_all >= 100 THEN 'analyzed' ELSE 'insufficient_data' END AS status,
       CASE WHEN n_all >= 100 THEN 100 END AS window_size,
       CASE WHEN n_all >= 100 THEN round(m, 6) END AS confidence_mean,
       CASE WHEN n_all >= 100 THEN round(s, 6) END AS confidence_std,
       CASE WHEN n_all >= 100 THEN round(low, 6) END AS low_confidence_ratio,
       CASE WHEN n_all >= 100 THEN concat_ws(',', CASE WHEN low > 0.3 THEN 'HIGH_LOW_CONFIDENCE_RATIO' END,
                                             CASE WHEN s > 0.25 THEN 'HIGH_CONFIDENCE_VARIANCE' END) END
         AS drift_alerts
FROM a, n""")

oracle("drift_distribution", f"""WITH {_LAST100}
SELECT prediction, count(*) AS n, round(count(*) / (SELECT count(*) FROM last100), 6) AS share
FROM last100 GROUP BY 1""")

oracle("staleness", f"""WITH {KPIS}, {PRED},
last50 AS (SELECT confidence FROM predictions ORDER BY ts DESC, seq DESC LIMIT 50),
b AS (SELECT (epoch_us((SELECT max(ts) FROM predictions)) - epoch_us(TIMESTAMP '2024-01-23 00:00:00'))
               / 3600000000.0::DOUBLE AS age,
             (SELECT requests_per_minute FROM kpis) AS rpm,
             CASE WHEN (SELECT count(*) FROM predictions) >= 50 THEN (SELECT avg(confidence) FROM last50) END AS conf,
             (SELECT count(*) FROM predictions) AS total_predictions),
r AS (SELECT *, list_filter([
        CASE WHEN age > 168 THEN {{'type': 'MODEL_AGE_HIGH', 'severity': CASE WHEN age > 720 THEN 'HIGH' ELSE 'MEDIUM' END}} END,
        CASE WHEN rpm < 0.1 AND age > 1 THEN {{'type': 'LOW_USAGE_VOLUME', 'severity': 'MEDIUM'}} END,
        CASE WHEN conf < 0.6 THEN {{'type': 'CONFIDENCE_DEGRADATION', 'severity': CASE WHEN conf < 0.5 THEN 'HIGH' ELSE 'MEDIUM' END}} END
      ], lambda x: x IS NOT NULL) AS alerts FROM b),
h AS (SELECT *, len(list_filter(alerts, lambda x: x.severity = 'HIGH')) AS hi,
             len(list_filter(alerts, lambda x: x.severity = 'MEDIUM')) AS med FROM r)
SELECT round(age, 6) AS model_age_hours, total_predictions, round(rpm, 6) AS requests_per_minute,
       round(conf, 6) AS recent_confidence,
       array_to_string(list_transform(alerts, lambda x: x.type || ':' || x.severity), ',') AS staleness_alerts,
       CAST(len(alerts) AS INTEGER) AS staleness_score,
       CASE WHEN len(alerts) = 0 THEN 'none'
            WHEN hi >= 2 THEN 'retrain_now'
            WHEN hi >= 1 THEN 'retrain_within_days'
            WHEN med >= 2 THEN 'watch_and_retrain_within_a_week'
            ELSE 'watch' END AS recommendation_code,
       CASE WHEN len(alerts) = 0 THEN 'model is fresh, keep serving it'
            WHEN hi >= 2 THEN 'start retraining today'
            WHEN hi >= 1 THEN 'schedule retraining within days'
            WHEN med >= 2 THEN 'watch daily, retraining due within a week'
            ELSE 'watch the next reports' END AS recommendation
FROM h""")

oracle("usage_by_client", f"""WITH {REQ}
SELECT user_agent AS client, count(*) AS requests, CAST(sum({ERRC}) AS BIGINT) AS errors,
       round(avg(response_time_ms), 6) AS avg_response_time_ms,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen
FROM requests GROUP BY 1""")

_x = "(response_time_ms / 0.01::DOUBLE)"
_b0 = f"floor(log2({_x}))"
_b1 = f"CASE WHEN pow(2.0, {_b0} + 1) <= {_x} THEN {_b0} + 1 ELSE {_b0} END"
_b2 = f"CASE WHEN pow(2.0, {_b1}) > {_x} THEN {_b1} - 1 ELSE {_b1} END"
oracle("latency_histogram", f"""WITH {REQ},
b AS (SELECT CAST(CASE WHEN {_x} < 1 THEN 0 ELSE least({_b2}, 63) END AS INTEGER) AS bucket FROM requests)
SELECT bucket, round(0.01::DOUBLE * pow(2.0, bucket), 6) AS lower_ms, count(*) AS n FROM b GROUP BY 1""")

oracle("alert_windows", f"""WITH {REQ},
err AS (SELECT 'ERROR_BURST' AS alert, time_bucket(INTERVAL 5 MINUTE, ts) AS start, count(*) AS v
        FROM requests WHERE status_code >= 400 GROUP BY 2 HAVING count(*) > 5),
w5 AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, count(*) AS n,
              list_sort(list(response_time_ms)) AS l FROM requests GROUP BY 1),
slow AS (SELECT 'SLOW_P95' AS alert, start, {fp('l', 'n', 0.95)} AS v FROM w5
         WHERE {fp('l', 'n', 0.95)} > 450.0),
active AS (SELECT DISTINCT date_trunc('minute', ts) AS m FROM requests),
covered AS (SELECT DISTINCT m + j * INTERVAL 1 MINUTE AS m FROM active, range(0, 10) r(j)),
bounds AS (SELECT min(date_trunc('minute', ts)) AS lo, max(date_trunc('minute', ts)) AS hi FROM requests),
cal AS (SELECT unnest(generate_series(lo + INTERVAL 9 MINUTE, hi, INTERVAL 1 MINUTE)) AS m FROM bounds),
quiet AS (SELECT 'LOW_TRAFFIC' AS alert, m AS start, 10.0::DOUBLE AS v FROM cal
          WHERE m NOT IN (SELECT m FROM covered))
SELECT alert, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, round(CAST(v AS DOUBLE), 6) AS value
FROM (SELECT * FROM err UNION ALL SELECT * FROM slow UNION ALL SELECT * FROM quiet)""")

oracle("dashboard_series", f"""WITH {REQ}, {PRED},
w5 AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, count(*) AS n,
              list_sort(list(response_time_ms)) AS l,
              avg(CASE WHEN status_code < 200 OR status_code >= 300 THEN 1.0 ELSE 0.0 END) AS non2 FROM requests GROUP BY 1),
s AS (
  SELECT 'request_rate_1m' AS series, date_trunc('minute', ts) AS start, '' AS key, CAST(count(*) AS DOUBLE) AS value
  FROM requests GROUP BY 2
  UNION ALL SELECT 'non_2xx_rate_5m', start, '', non2 FROM w5
  UNION ALL SELECT 'latency_p50_5m', start, '', {fp('l', 'n', 0.5)} FROM w5
  UNION ALL SELECT 'latency_p95_5m', start, '', {fp('l', 'n', 0.95)} FROM w5
  UNION ALL SELECT 'class_mix_1h', date_trunc('hour', ts), prediction, CAST(count(*) AS DOUBLE)
  FROM predictions GROUP BY 2, 3
  UNION ALL SELECT 'low_confidence_1h', date_trunc('hour', ts), '',
         avg(CASE WHEN confidence < 0.7 THEN 1.0 ELSE 0.0 END) FROM predictions GROUP BY 2)
SELECT series, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, key, round(value, 6) AS value FROM s""")


# --- features --------------------------------------------------------------------------

from corpusflow.functions import stopwords  # noqa: E402
from corpusflow.operators import features as fe  # noqa: E402

STOPS = S.str_list(sorted(set(stopwords.english())))


def _nc_switch(col: str) -> str:
    return ("CASE WHEN sw.dates AND sw.phones THEN " + S.normalize_conservative(col, True, True)
            + " WHEN sw.dates THEN " + S.normalize_conservative(col, True, False)
            + " WHEN sw.phones THEN " + S.normalize_conservative(col, False, True)
            + " ELSE " + S.normalize_conservative(col) + " END")


DOCS = CLEAN + ", " + _sw + f""",
docs AS (SELECT doc_id, lang AS label, sample_name, description, transcription,
                {_nc_switch('transcription')} AS transcription_cleaned,
                {_nc_switch('description')} AS description_cleaned
         FROM clean_docs, sw)"""


def _terms(src: str, col: str, ngram=(1, 2), stops=True, pattern=tx.TOKEN_PATTERN, prefix="") -> str:
    """CTEs {prefix}ta, {prefix}terms, {prefix}counts (doc_id, term, tf) over ``src``."""
    p = prefix
    toks = f"regexp_extract_all(lower(coalesce({col}, '')), {S.q(pattern)}, 0)"
    if stops:
        toks = f"list_filter({toks}, lambda x: NOT list_contains({STOPS}, x))"
    parts = []
    for n in range(ngram[0], ngram[1] + 1):
        if n == 1:
            parts.append(f"SELECT doc_id, unnest(arr) AS term FROM {p}ta")
        else:
            joined = " || ' ' || ".join(f"arr[i + {k}]" for k in range(n))
            parts.append(f"SELECT doc_id, unnest(list_transform(range(1, len(arr) - {n - 2}), "
                         f"lambda i: {joined})) AS term FROM {p}ta")
    return f"""{p}ta AS (SELECT doc_id, {toks} AS arr FROM {src}),
  {p}terms AS ({' UNION ALL '.join(parts)}),
  {p}counts AS (SELECT doc_id, term, count(*) AS tf FROM {p}terms GROUP BY ALL)"""


def _char_terms(src: str, col: str, lo=3, hi=5, prefix="") -> str:
    p = prefix
    s = S.collapse_ws(f"coalesce({col}, '')")
    parts = " UNION ALL ".join(
        f"SELECT doc_id, unnest(list_transform(range(1, length(s) - {n} + 2), lambda i: substr(s, i, {n}))) AS term "
        f"FROM {p}ta" for n in range(lo, hi + 1))
    return f"""{p}ta AS (SELECT doc_id, {s} AS s FROM {src}),
  {p}terms AS ({parts}),
  {p}counts AS (SELECT doc_id, term, count(*) AS tf FROM {p}terms GROUP BY ALL)"""


def _vocab(n_src: str, min_df=2, max_df=0.95, max_features=5000, prefix="") -> str:
    p = prefix
    hi = f"{max_df}::DOUBLE * {p}nd.n" if isinstance(max_df, float) else str(max_df)
    return f"""{p}nd AS (SELECT count(*) AS n FROM {n_src}),
  {p}vs AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM {p}counts GROUP BY term),
  {p}vk AS (SELECT {p}vs.* FROM {p}vs, {p}nd WHERE df >= {min_df} AND df <= {hi}
            ORDER BY cf DESC, term ASC LIMIT {max_features}),
  {p}vocab AS (SELECT term, CAST(df AS BIGINT) AS df, CAST(cf AS BIGINT) AS cf,
                      ln((1.0::DOUBLE + {p}nd.n) / (1.0::DOUBLE + df)) + 1.0 AS idf,
                      row_number() OVER (ORDER BY term) - 1 AS feature_index FROM {p}vk, {p}nd)"""


def _tfidf(prefix="", counts=None) -> str:
    p = prefix
    c = counts or f"{p}counts"
    return f"""{p}w AS (SELECT c.doc_id, c.term, c.tf * v.idf AS w FROM {c} c JOIN {p}vocab v ON c.term = v.term),
  {p}tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM {p}w)"""


_LEN = fe.LENGTH_FEATURES
_CAT = fe.CATEGORY_FEATURES


def _dense(src: str, serving=False, index_src="docs") -> str:
    tc = "CAST(coalesce(length(transcription), 0) AS DOUBLE)"
    dc = "0.0::DOUBLE" if serving else "CAST(coalesce(length(description), 0) AS DOUBLE)"
    dw = "0.0::DOUBLE" if serving else f"CAST({S.word_count('description')} AS DOUBLE)"
    flags = ", ".join(f"CAST(coalesce(contains(lower(transcription), '{w}'), false) AS DOUBLE) AS has_{w}"
                      for w in tx.SECTION_WORDS)
    return f"""sidx AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS label_id
           FROM (SELECT DISTINCT coalesce(sample_name, 'unknown') AS label FROM {index_src})),
  dense AS (SELECT doc_id, {tc} AS transcription_char_length,
                   CAST({S.word_count('transcription')} AS DOUBLE) AS transcription_word_count,
                   {dc} AS description_char_length, {dw} AS description_word_count,
                   {tc} / ({dc} + 1) AS text_length_ratio,
                   CAST({S.length_category_code('length(transcription)')} AS DOUBLE) AS text_length_category,
                   {flags},
                   CAST(coalesce(sidx.label_id, 0) AS DOUBLE) AS sample_name_encoded
            FROM {src} LEFT JOIN sidx ON coalesce({src}.sample_name, 'unknown') = sidx.label)"""


def _matrix(tfidf="tfidf") -> str:
    cols = ", ".join(_LEN + _CAT)
    return f"""dl AS (SELECT doc_id, feature, value FROM (UNPIVOT (SELECT doc_id, {cols} FROM dense)
                ON {cols} INTO NAME feature VALUE value) WHERE value <> 0),
  matrix AS (SELECT doc_id, 'tfidf_' || term AS feature, value FROM {tfidf}
             UNION ALL SELECT doc_id, feature, value FROM dl)"""


FEAT = DOCS + ", " + _terms("docs", "transcription_cleaned") + ", " + _vocab("docs") + ", " + _tfidf() \
    + ", " + _dense("docs") + ", " + _matrix()

PER_DOC = "SELECT doc_id, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens FROM counts GROUP BY 1"
MATRIX_SUMMARY = "SELECT doc_id, count(*) AS nnz, round(sum(value), 6) AS total FROM {t} GROUP BY 1"
FEATURE_SUMMARY = "SELECT feature, count(*) AS nnz, round(sum(value), 6) AS total FROM {t} GROUP BY 1"

oracle("tokens", f"WITH {DOCS}, {_terms('docs', 'transcription_cleaned', (1, 1), stops=False)}\n{PER_DOC}")
oracle("ngrams_1_2", f"WITH {DOCS}, {_terms('docs', 'transcription_cleaned', (1, 2))}\n{PER_DOC}")

VDOCS = CLEAN + f", vdocs AS (SELECT doc_id, {S.normalize_simple('transcription')} AS t FROM clean_docs)"
oracle("ngrams_1_3", f"WITH {VDOCS}, {_terms('vdocs', 't', (1, 3), pattern=tx.DEFAULT_TOKEN_PATTERN)}\n{PER_DOC}")

oracle("vocabulary", f"""WITH {DOCS}, {_terms('docs', 'transcription_cleaned')}, {_vocab('docs')}
SELECT term, df, cf, round(idf, 6) AS idf, feature_index FROM vocab""")
oracle("tfidf", f"""WITH {DOCS}, {_terms('docs', 'transcription_cleaned')}, {_vocab('docs')}, {_tfidf()}
SELECT doc_id, term, round(value, 6) AS value FROM tfidf""")
oracle("tfidf_top_terms", f"""WITH {DOCS}, {_terms('docs', 'transcription_cleaned')}, {_vocab('docs')}, {_tfidf()}
SELECT term, round(sum(value) / (SELECT count(*) FROM docs), 6) AS mean_value FROM tfidf
GROUP BY term ORDER BY sum(value) / (SELECT count(*) FROM docs) DESC, term ASC LIMIT 10""")

oracle("count_features", f"""WITH {VDOCS}, {_terms('vdocs', 't', (1, 2), pattern=tx.DEFAULT_TOKEN_PATTERN)},
  {_vocab('vdocs', 2, 0.95, 2000)},
  cm AS (SELECT c.doc_id, CAST(c.tf AS DOUBLE) AS value FROM counts c JOIN vocab v ON c.term = v.term)
{MATRIX_SUMMARY.format(t='cm')}""")

oracle("char_ngrams", f"""WITH {VDOCS}, {_char_terms('vdocs', 't')}, {_vocab('vdocs', 2, 0.95, 1500)}, {_tfidf()}
{MATRIX_SUMMARY.format(t='tfidf')}""")

oracle("label_encode", f"""WITH {CLEAN}
SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS label_id
FROM (SELECT DISTINCT medical_specialty AS label FROM clean_docs WHERE medical_specialty IS NOT NULL)""")

oracle("category_encode", f"""WITH {S.RAW_DOCS},
idx AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS label_id
        FROM (SELECT DISTINCT coalesce(sample_name, 'unknown') AS label FROM raw_docs))
SELECT doc_id, coalesce(idx.label_id, 0) AS sample_name_encoded
FROM raw_docs LEFT JOIN idx ON coalesce(raw_docs.sample_name, 'unknown') = idx.label""")

oracle("feature_matrix", f"WITH {FEAT}\n{FEATURE_SUMMARY.format(t='matrix')}")

oracle("minmax_scale", f"""WITH {FEAT},
mm AS (SELECT feature, count(*) AS nnz, min(value) AS mn, max(value) AS mx FROM matrix GROUP BY 1),
st AS (SELECT feature,
              CASE WHEN nnz < (SELECT count(*) FROM docs) THEN least(mn, 0.0) ELSE mn END AS mn,
              CASE WHEN nnz < (SELECT count(*) FROM docs) THEN greatest(mx, 0.0) ELSE mx END AS mx FROM mm),
sc AS (SELECT m.doc_id, m.feature,
              (m.value - st.mn) / CASE WHEN st.mx - st.mn = 0 THEN 1.0 ELSE st.mx - st.mn END AS value
       FROM matrix m JOIN st ON m.feature = st.feature),
nz AS (SELECT * FROM sc WHERE value <> 0)
{FEATURE_SUMMARY.format(t='nz')}""")

oracle("standard_scale", f"""WITH {FEAT}
SELECT doc_id, """ + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1.0 "
    f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in _LEN) + " FROM dense")

oracle("matrix_stats", f"""WITH {FEAT},
ms_nd AS (SELECT (SELECT count(*) FROM docs) AS n, (SELECT count(*) FROM vocab) + {len(_LEN + _CAT)} AS d),
ms_s AS (SELECT count(*) AS nnz, sum(value) AS s, min(value) AS mn, max(value) AS mx FROM matrix)
SELECT CAST(n AS BIGINT) AS n_docs, CAST(d AS BIGINT) AS n_features, nnz,
       round(100.0::DOUBLE * (1.0 - nnz / (n * d)), 6) AS sparsity_pct,
       round(100.0::DOUBLE * nnz / (n * d), 6) AS density_pct,
       round(CASE WHEN nnz < n * d THEN least(mn, 0.0) ELSE mn END, 6) AS min,
       round(CASE WHEN nnz < n * d THEN greatest(mx, 0.0) ELSE mx END, 6) AS max,
       round(s / (n * d), 6) AS mean
FROM ms_nd, ms_s""")

_new = f"""new AS (SELECT item_id AS doc_id, CAST(NULL AS VARCHAR) AS sample_name, CAST(NULL AS VARCHAR) AS description,
                {S.clean_text('text')} AS transcription FROM benchmark),
  new2 AS (SELECT *, {S.normalize_conservative('transcription')} AS transcription_cleaned FROM new)"""
oracle("transform_new", f"""WITH {DOCS}, {_terms('docs', 'transcription_cleaned')}, {_vocab('docs')}, {_new},
  {_terms('new2', 'transcription_cleaned', prefix='n_')}, {_tfidf(counts='n_counts')},
  {_dense('new2', serving=True, index_src='docs')}, {_matrix()}
{MATRIX_SUMMARY.format(t='matrix')}""")

oracle("feature_pipeline", f"WITH {FEAT}\n{MATRIX_SUMMARY.format(t='matrix')}")


# --- selection and models ------------------------------------------------------------

LAB = FEAT + """,
  lidx AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS class_id
           FROM (SELECT DISTINCT label FROM docs WHERE label IS NOT NULL)),
  labels AS (SELECT d.doc_id, d.label, lidx.class_id FROM docs d LEFT JOIN lidx ON d.label = lidx.label),
  sizes AS (SELECT class_id, count(*) AS n_c FROM labels GROUP BY 1),
  nk AS (SELECT sum(n_c) AS n, count(*) AS k FROM sizes),
  cfs AS (SELECT m.feature, l.class_id, count(*) AS a, sum(m.value) AS s1, sum(m.value * m.value) AS s2
          FROM matrix m JOIN labels l ON m.doc_id = l.doc_id GROUP BY ALL)"""

FSC = """fsc AS (
  SELECT feature, CASE WHEN ((s2 - s1 * s1 / n) - (br - s1 * s1 / n)) / (n - k) > 0
                       THEN ((br - s1 * s1 / n) / (k - 1)) / (((s2 - s1 * s1 / n) - (br - s1 * s1 / n)) / (n - k))
                  END AS score
  FROM (SELECT c.feature, sum(c.s1) AS s1, sum(c.s2) AS s2, sum(c.s1 * c.s1 / s.n_c) AS br
        FROM cfs c JOIN sizes s ON c.class_id = s.class_id GROUP BY 1), nk)"""

MIS = """mi_df AS (SELECT feature, sum(a) AS df, sum(n_c) AS npc FROM cfs JOIN sizes USING (class_id) GROUP BY 1),
  mis AS (
  SELECT c.feature,
         sum(CASE WHEN c.a > 0 THEN (c.a / nk.n) * ln((c.a / nk.n) / ((m.df / nk.n) * (s.n_c / nk.n))) ELSE 0 END
           + CASE WHEN s.n_c - c.a > 0 THEN ((s.n_c - c.a) / nk.n)
                  * ln(((s.n_c - c.a) / nk.n) / ((1.0 - m.df / nk.n) * (s.n_c / nk.n))) ELSE 0 END)
         + max(CASE WHEN (nk.n - m.npc) > 0 AND (1.0 - m.df / nk.n) > 0
                    THEN ((nk.n - m.npc) / nk.n) * ln(1.0 / (1.0 - m.df / nk.n)) ELSE 0 END) AS score
  FROM cfs c JOIN sizes s ON c.class_id = s.class_id JOIN mi_df m ON c.feature = m.feature, nk
  GROUP BY c.feature)"""

VAR = """fv AS (SELECT feature, CASE WHEN feature LIKE 'tfidf\\_%' ESCAPE '\\' THEN 'tfidf'
                            WHEN feature IN (""" + ", ".join(S.q(x) for x in _LEN) + """) THEN 'length'
                            ELSE 'other' END AS kind,
              greatest(s2 / (SELECT count(*) FROM docs) - (s1 / (SELECT count(*) FROM docs)) ** 2, 0.0) AS variance
       FROM (SELECT feature, sum(value) AS s1, sum(value * value) AS s2 FROM matrix GROUP BY 1))"""

oracle("feature_variance", f"""WITH {FEAT}, {VAR}
SELECT coalesce(kind, 'all') AS kind, count(*) AS n_features,
       CAST(sum(CASE WHEN variance < 0.01 THEN 1 ELSE 0 END) AS BIGINT) AS n_low_variance,
       round(min(variance), 9) AS min_variance, round(max(variance), 9) AS max_variance,
       round(avg(variance), 9) AS mean_variance, round(quantile_cont(variance, 0.5), 9) AS median_variance
FROM fv GROUP BY ROLLUP (kind)""")

oracle("drop_constant_features", f"""WITH {FEAT},
mm AS (SELECT feature, count(*) AS nnz, min(value) AS mn, max(value) AS mx FROM matrix GROUP BY 1)
SELECT feature, nnz FROM mm WHERE NOT (nnz = (SELECT count(*) FROM docs) AND mn = mx)""")

oracle("f_score", f"WITH {LAB}, {FSC}\nSELECT feature, round(score, 6) AS score FROM fsc")

oracle("chi2_score", f"""WITH {LAB},
ch AS (SELECT c.feature, sum(c.s1) AS t, sum(c.s1 * c.s1 / (s.n_c / nk.n)) AS q
       FROM cfs c JOIN sizes s ON c.class_id = s.class_id, nk GROUP BY 1)
SELECT feature, round(CASE WHEN t > 0 THEN q / t - t END, 6) AS score FROM ch""")

oracle("mutual_info", f"WITH {LAB}, {MIS}\nSELECT feature, round(score, 6) AS score FROM mis")

oracle("select_k_best", f"""WITH {LAB}, {FSC}
SELECT feature, round(score, 6) AS score FROM fsc WHERE score IS NOT NULL
ORDER BY fsc.score DESC, feature ASC LIMIT 500""")

oracle("selector_overlap", f"""WITH {LAB}, {FSC}, {MIS},
sel_a AS (SELECT feature FROM fsc WHERE score IS NOT NULL ORDER BY score DESC, feature LIMIT 100),
sel_b AS (SELECT feature FROM mis WHERE score IS NOT NULL ORDER BY score DESC, feature LIMIT 100)
SELECT count(*) AS shared, 100 AS k, count(*) / 100.0::DOUBLE AS agreement FROM sel_a JOIN sel_b USING (feature)""")

_DIM = """dim AS (SELECT (SELECT count(*) FROM docs) AS n_samples,
                    (SELECT count(*) FROM vocab) + """ + str(len(_LEN + _CAT)) + """ AS n_features,
                    (SELECT count(DISTINCT class_id) FROM labels) AS n_classes)"""
oracle("dimensionality", f"""WITH {LAB}, {_DIM}
SELECT n_samples, n_features, round(n_samples / n_features, 6) AS samples_per_feature, n_classes,
       CASE WHEN n_features > n_samples THEN 'HIGH' WHEN n_features > 0.5 * n_samples THEN 'MEDIUM' ELSE 'OK' END
         AS risk FROM dim""")

oracle("model_advice", f"""WITH {LAB}, {_DIM},
ms AS (SELECT count(*) AS nnz, min(value) AS mn, max(value) AS mx FROM matrix),
st AS (SELECT CASE WHEN nnz < n_samples * n_features THEN least(mn, 0.0) ELSE mn END AS mn,
              CASE WHEN nnz < n_samples * n_features THEN greatest(mx, 0.0) ELSE mx END AS mx,
              100.0 * nnz / (n_samples * n_features) AS density FROM ms, dim),
r AS (
  SELECT 0 AS "order", 'HIGH_DIMENSIONAL' AS rule, 'regularised linear models or naive Bayes' AS advice,
         n_features > n_samples AS fires FROM dim
  UNION ALL SELECT 1, 'MANY_FEATURES', 'feature selection before distance-based models', n_features > 1000 FROM dim
  UNION ALL SELECT 2, 'MANY_CLASSES', 'models with native multi-class support', n_classes > 10 FROM dim
  UNION ALL SELECT 3, 'UNIT_RANGE', 'multinomial naive Bayes works on these values', mn >= 0 AND mx <= 1 FROM st
  UNION ALL SELECT 4, 'SMALL_SAMPLE', 'simple models and cross-validation', n_samples < 5000 FROM dim
  UNION ALL SELECT 5, 'SPARSE', 'sparse-aware models (naive Bayes, linear)', density < 10 FROM st)
SELECT CAST("order" AS INTEGER) AS "order", rule, advice FROM r WHERE fires""")

CORR = """csel AS (SELECT feature FROM fsc WHERE score IS NOT NULL ORDER BY round(score, 6) DESC, feature LIMIT 1000),
  cm AS (SELECT m.* FROM matrix m SEMI JOIN csel USING (feature)),
  cst AS (SELECT feature, sum(value) AS s1, sum(value * value) AS s2, (SELECT count(*) FROM docs) AS n FROM cm GROUP BY 1),
  cok AS (SELECT feature, s1, n, sqrt(n * s2 - s1 * s1) AS root FROM cst WHERE n * s2 - s1 * s1 > 1e-12 * n * s2),
  cpp AS (SELECT a.feature AS f1, b.feature AS f2, sum(a.value * b.value) AS s FROM cm a JOIN cm b ON a.doc_id = b.doc_id AND a.feature < b.feature
          GROUP BY ALL),
  cpairs AS (SELECT a.feature AS feature_1, b.feature AS feature_2, (a.n * coalesce(s, 0.0) - a.s1 * b.s1) / (a.root * b.root) AS r
             FROM cok a JOIN cok b ON a.feature < b.feature LEFT JOIN cpp ON f1 = a.feature AND f2 = b.feature)"""

oracle("feature_correlation", f"""WITH {LAB}, {FSC}, {CORR}
SELECT count(*) AS pairs, round(avg(abs(r)), 6) AS mean_abs_r, round(max(abs(r)), 6) AS max_abs_r,
       count(*) FILTER (abs(r) > 0.5) AS pairs_above_0_5, count(*) FILTER (abs(r) > 0.8) AS pairs_above_0_8 FROM cpairs""")

oracle("correlated_pairs", f"""WITH {LAB}, {FSC}, {CORR}
SELECT feature_1, feature_2, round(r, 6) AS r, abs(round(r, 6)) > 0.8 AS high FROM cpairs WHERE abs(round(r, 6)) > 0.5""")

oracle("selection_advice", f"""WITH {LAB}, {VAR}, {_DIM}, {FSC}, {CORR},
c AS (SELECT sum(CASE WHEN variance = 0 THEN 1 ELSE 0 END) AS zero,
             sum(CASE WHEN variance < 0.01 THEN 1 ELSE 0 END) AS low FROM fv),
hc AS (SELECT count(*) AS high FROM cpairs WHERE abs(r) > 0.8)
SELECT CAST("order" AS INTEGER) AS "order", strategy, CAST(n_features AS BIGINT) AS n_features FROM (
  SELECT 1 AS "order", 'REMOVE_CONSTANT' AS strategy, zero AS n_features FROM c WHERE zero > 0
  UNION ALL SELECT 2, 'REMOVE_LOW_VARIANCE', low FROM c WHERE low > 0
  UNION ALL SELECT 3, 'REMOVE_CORRELATED', high FROM hc WHERE high > 0
  UNION ALL SELECT 4, 'UNIVARIATE_SELECTION', n_features FROM dim WHERE n_features > 1000)""")

SPLIT = """ranked AS (SELECT doc_id, class_id,
                     row_number() OVER (PARTITION BY class_id ORDER BY md5(CAST(doc_id AS VARCHAR) || '|42'), doc_id)
                       AS rank,
                     count(*) OVER (PARTITION BY class_id) AS n_c FROM labels),
  sp AS (SELECT doc_id, class_id, rank <= ceil(0.2::DOUBLE * n_c) AS is_test FROM ranked)"""
oracle("split_holdout", f"WITH {LAB}, {SPLIT}\nSELECT doc_id, class_id, is_test FROM sp")
oracle("kfold_assign", f"WITH {LAB}, {SPLIT}\nSELECT doc_id, class_id, CAST((rank - 1) % 3 AS INTEGER) AS fold FROM ranked")

NB = LAB + ", " + SPLIT + f""",
  train AS (SELECT doc_id, class_id FROM sp WHERE NOT is_test),
  test AS (SELECT doc_id, class_id FROM sp WHERE is_test),
  dd AS (SELECT (SELECT count(*) FROM vocab) + {len(_LEN + _CAT)} AS d),
  tsz AS (SELECT class_id, count(*) AS n_c FROM train GROUP BY 1),
  tn AS (SELECT sum(n_c) AS n, count(*) AS k FROM tsz),
  nfc AS (SELECT m.feature, t.class_id, sum(m.value) AS nfc FROM matrix m JOIN train t ON m.doc_id = t.doc_id
          GROUP BY ALL),
  ncl AS (SELECT tsz.class_id, tsz.n_c, coalesce(x.nc_sum, 0.0) AS big_n
          FROM tsz LEFT JOIN (SELECT class_id, sum(nfc) AS nc_sum FROM nfc GROUP BY 1) x ON tsz.class_id = x.class_id),
  tm AS (SELECT m.* FROM matrix m SEMI JOIN test t ON m.doc_id = t.doc_id),
  tf AS (SELECT feature, sum(nfc) AS t_f FROM nfc GROUP BY 1),
  tot AS (SELECT sum(t_f) AS t FROM tf)"""


def _nb_pred(weight: str, prior: str, p: str = "") -> str:
    return f"""{p}th AS (SELECT f.feature, c.class_id, {weight} AS w
             FROM (SELECT DISTINCT feature FROM tm) f CROSS JOIN ncl c
             LEFT JOIN nfc n ON n.feature = f.feature AND n.class_id = c.class_id
             LEFT JOIN tf ON tf.feature = f.feature, dd, tot),
  {p}sc AS (SELECT t.doc_id, t.class_id AS true_c, c.class_id,
                   {prior} + coalesce(sum(tm.value * {p}th.w), 0.0) AS score
         FROM test t CROSS JOIN ncl c LEFT JOIN tm ON tm.doc_id = t.doc_id
         LEFT JOIN {p}th ON {p}th.feature = tm.feature AND {p}th.class_id = c.class_id, tn
         GROUP BY t.doc_id, t.class_id, c.class_id, c.n_c, tn.n, tn.k),
  {p}sc2 AS (SELECT *, max(score) OVER (PARTITION BY doc_id) AS mx,
                 row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class_id ASC) AS r FROM {p}sc),
  {p}sc3 AS (SELECT *, sum(exp(score - mx)) OVER (PARTITION BY doc_id) AS z FROM {p}sc2),
  {p}pred AS (SELECT doc_id, true_c AS class_id, class_id AS pred_class_id, 1.0 / z AS confidence
              FROM {p}sc3 WHERE r = 1)"""


MULTI = _nb_pred("ln((coalesce(n.nfc, 0.0) + 1.0) / (c.big_n + 1.0 * dd.d))", "ln(c.n_c / tn.n)")
COMPL = _nb_pred("-ln((coalesce(tf.t_f, 0.0) - coalesce(n.nfc, 0.0) + 1.0) / (tot.t - c.big_n + 1.0 * dd.d))", "0.0")

oracle("nb_train", f"""WITH {NB},
cls AS (SELECT class_id, ln(n_c / tn.n) AS base, ln(1.0) - ln(big_n + 1.0 * dd.d) AS slope FROM ncl, tn, dd),
nb_dl AS (SELECT class_id, count(*) AS n_deltas, sum(ln(nfc + 1.0) - ln(1.0)) AS sum_delta FROM nfc GROUP BY 1)
SELECT cls.class_id, round(base, 6) AS base, round(slope, 6) AS slope, n_deltas, round(sum_delta, 6) AS sum_delta
FROM cls LEFT JOIN nb_dl ON cls.class_id = nb_dl.class_id""")

oracle("nb_predict", f"WITH {NB}, {MULTI}\nSELECT doc_id, class_id, pred_class_id, round(confidence, 6) AS confidence FROM pred")
oracle("complement_nb", f"WITH {NB}, {COMPL}\nSELECT doc_id, class_id, pred_class_id, round(confidence, 6) AS confidence FROM pred")

oracle("confusion_matrix", f"""WITH {NB}, {MULTI}
SELECT class_id AS label, pred_class_id AS predicted, count(*) AS n FROM pred GROUP BY ALL""")

oracle("classification_report", f"""WITH {NB}, {MULTI},
cm AS (SELECT class_id AS label, pred_class_id AS predicted, count(*) AS n FROM pred GROUP BY ALL),
cl AS (SELECT label AS c FROM cm UNION SELECT predicted FROM cm),
per AS (SELECT cl.c,
               coalesce((SELECT sum(n) FROM cm WHERE label = cl.c AND predicted = cl.c), 0) AS tp,
               coalesce((SELECT sum(n) FROM cm WHERE label = cl.c), 0) AS support,
               coalesce((SELECT sum(n) FROM cm WHERE predicted = cl.c), 0) AS predicted_n FROM cl),
cr AS (SELECT c, tp, support,
              CASE WHEN predicted_n > 0 THEN tp / predicted_n ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
      FROM cr),
t AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
             sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM f)
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', round(tp / n, 6), round(tp / n, 6), round(tp / n, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), CAST(n AS BIGINT) FROM t""")


# --- streaming twins (append mode emits windows closed by the 1-hour watermark) -------------

_MAXT = "(SELECT max(ts) FROM events)"
oracle("stream_hourly_kpis", f"""WITH {REQ}
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests,
       CAST(sum({ERRC}) AS BIGINT) AS errors, round(avg(response_time_ms), 6) AS avg_response_time
FROM requests GROUP BY time_bucket(INTERVAL 1 HOUR, ts)
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {_MAXT} - INTERVAL 1 HOUR""")

oracle("stream_sliding_kpis", f"""WITH {REQ},
w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - j * INTERVAL 10 MINUTE AS s, status_code, response_time_ms
      FROM requests, range(0, 6) r(j))
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests,
       round(avg(CASE WHEN status_code >= 400 THEN 1.0 ELSE 0.0 END) * 100, 6) AS error_rate_percent,
       round(list_sort(list(response_time_ms))[CAST(ceil(0.95::DOUBLE * count(*)) AS INTEGER)], 6) AS p95
FROM w GROUP BY s HAVING s + INTERVAL 60 MINUTE <= {_MAXT} - INTERVAL 1 HOUR""")

oracle("stream_newest", f"""WITH {PRED},
p AS (SELECT *, 'v' || (seq % 3) AS v, row_number() OVER (PARTITION BY seq % 3 ORDER BY ts DESC, seq DESC) AS rn,
             count(*) OVER (PARTITION BY seq % 3) AS total FROM predictions),
a AS (SELECT v, max(total) >= 100 AS ok, avg(confidence) AS m, stddev_pop(confidence) AS s,
             avg(CASE WHEN confidence < 0.7 THEN 1.0 ELSE 0.0 END) AS low FROM p WHERE rn <= 100 GROUP BY v)
SELECT v AS model_version, CASE WHEN ok THEN 'analyzed' ELSE 'insufficient_data' END AS status, CASE WHEN ok THEN 100 END AS window_size,
       CASE WHEN ok THEN round(m, 6) END AS confidence_mean, CASE WHEN ok THEN round(s, 6) END AS confidence_std,
       CASE WHEN ok THEN round(low, 6) END AS low_confidence_ratio,
       CASE WHEN ok THEN concat_ws(',', CASE WHEN low > 0.3 THEN 'HIGH_LOW_CONFIDENCE_RATIO' END,
                                   CASE WHEN s > 0.25 THEN 'HIGH_CONFIDENCE_VARIANCE' END) END AS drift_alerts
FROM a""")

#: Minutes that the 1-hour watermark has closed; the watermark is rounded down to milliseconds.
_WM = f"(date_trunc('millisecond', {_MAXT}) - INTERVAL 1 HOUR)"
oracle("stream_quiet", f"""WITH {REQ},
active AS (SELECT DISTINCT endpoint AS key, date_trunc('minute', ts) AS m FROM requests
           WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {_WM}),
nxt AS (SELECT key, m, lead(m) OVER (PARTITION BY key ORDER BY m) AS nm FROM active),
quiet AS (SELECT key, unnest(generate_series(m + INTERVAL 10 MINUTE, coalesce(nm, date_trunc('minute', {_WM})) - INTERVAL 1 MINUTE,
                                             INTERVAL 1 MINUTE)) AS m FROM nxt),
lasts AS (SELECT r.endpoint AS key, a.nm, max(r.ts) AS last FROM requests r JOIN nxt a ON r.endpoint = a.key AND date_trunc('minute', r.ts) = a.m
          GROUP BY ALL),
absent AS (SELECT key, last FROM lasts WHERE nm IS NULL AND {_WM} > last + INTERVAL 23 HOUR)
SELECT key, 'LOW_TRAFFIC' AS alert, strftime(m, '%Y-%m-%d %H:%M:%S') AS start FROM quiet
UNION ALL SELECT key, 'ABSENT', strftime(last, '%Y-%m-%d %H:%M:%S') FROM absent""")

oracle("stream_bursts", f"""WITH {REQ},
w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS s, CAST(sum({ERRC}) AS DOUBLE) AS errors,
             list_sort(list(response_time_ms))[CAST(ceil(0.95::DOUBLE * count(*)) AS INTEGER)] AS p95 FROM requests GROUP BY 1
      HAVING time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= {_WM})
SELECT 'ERROR_BURST' AS alert, strftime(s, '%Y-%m-%d %H:%M:%S') AS start, round(errors, 6) AS value FROM w WHERE errors > 1
UNION ALL SELECT 'SLOW_P95', strftime(s, '%Y-%m-%d %H:%M:%S'), round(p95, 6) FROM w WHERE p95 > 450.0""")

oracle("stream_quarantine", f"""WITH t AS (
  SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 11 = 0 THEN '  ' ELSE text END AS text, (conv_id * 3 + turn) % 7 = 0 AS cut FROM conversations),
r AS (SELECT cut, text, {_strip} AS s FROM t)
SELECT CASE WHEN cut THEN 'corrupt' WHEN text IS NULL THEN 'null' WHEN text = '' THEN 'empty' WHEN coalesce(s, '') = '' THEN 'blank' ELSE 'scored' END AS outcome,
       count(*) AS n FROM r GROUP BY 1""")

oracle("sketch_report", f"""WITH {REQ}
SELECT endpoint, count(*) AS requests, count(*) FILTER (status_code >= 400) AS errors, round(avg(response_time_ms), 6) AS avg_response_time_ms
FROM requests GROUP BY 1""")

oracle("stream_running_perf", PERF)

oracle("stream_alerts", f"""WITH {REQ},
h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, count(*) AS requests, sum({ERRC}) AS errors
      FROM requests GROUP BY 1 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {_MAXT} - INTERVAL 1 HOUR)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, requests, CAST(errors AS BIGINT) AS errors,
       'HIGH_ERROR_RATE' AS alert FROM h WHERE errors * 100.0 / requests > 30.0""")

oracle("stream_dedup", "SELECT count(DISTINCT substr(sha256(props), 1, 16)) AS n_kept FROM events")


# --- scoring and jobs --------------------------------------------------------------------

from corpusflow.operators.score import FEATURE_KIND_RULES  # noqa: E402

_kind_case = "CASE " + " ".join(f"WHEN regexp_matches(feature, {S.q(rx)}) THEN '{name}'"
                                for name, rx in FEATURE_KIND_RULES) + " ELSE 'other' END"
oracle("feature_kinds", f"""WITH {FEAT}
SELECT {_kind_case} AS kind, count(*) AS n_features FROM (SELECT DISTINCT feature FROM matrix) GROUP BY 1""")

oracle("score_errors", f"""WITH t AS (
  SELECT conv_id * 1000000 + turn AS doc_id, CASE WHEN (conv_id + turn) % 11 = 0 THEN '  ' ELSE text END AS text FROM conversations),
r AS (SELECT *, {_strip} AS s FROM t)
SELECT doc_id, 'PREDICTION_ERROR' AS event_type, substr(sha256(coalesce(text, '')), 1, 16) AS input_hash, 'ValidationError' AS error_type,
       CASE WHEN text IS NULL THEN 'null' WHEN text = '' THEN 'empty' ELSE 'blank' END AS error_message,
       row_number() OVER (ORDER BY doc_id) AS total_errors
FROM r WHERE coalesce(s, '') = ''""")

oracle("model_gate", f"""WITH {NB}, {MULTI},
a AS (SELECT avg(CASE WHEN class_id = pred_class_id THEN 1.0 ELSE 0.0 END) AS accuracy FROM pred)
SELECT round(accuracy, 6) AS accuracy,
       CASE WHEN accuracy < 0.4 THEN 'failed' WHEN accuracy < 0.6 THEN 'warning' ELSE 'passed' END AS status
FROM a""")


_UNIF = _nb_pred("ln((coalesce(n.nfc, 0.0) + 1.0) / (c.big_n + 1.0 * dd.d))", "-ln(tn.k)", "u_")
_CMPL = _nb_pred("-ln((coalesce(tf.t_f, 0.0) - coalesce(n.nfc, 0.0) + 1.0) / (tot.t - c.big_n + 1.0 * dd.d))",
                 "0.0", "c_")
oracle("leaderboard", f"""WITH {NB}, {MULTI}, {_UNIF}, {_CMPL},
res AS (
  SELECT 'multinomial_nb' AS name, avg(CASE WHEN class_id = pred_class_id THEN 1.0 ELSE 0.0 END) AS accuracy FROM pred
  UNION ALL SELECT 'multinomial_nb_uniform_prior', avg(CASE WHEN class_id = pred_class_id THEN 1.0 ELSE 0.0 END)
  FROM u_pred
  UNION ALL SELECT 'complement_nb', avg(CASE WHEN class_id = pred_class_id THEN 1.0 ELSE 0.0 END) FROM c_pred),
kk AS (SELECT count(DISTINCT class_id) AS k FROM labels)
SELECT CAST(rank() OVER (ORDER BY accuracy DESC, name ASC) AS INTEGER) AS rank, name, round(accuracy, 6) AS accuracy,
       round(accuracy - 0.37, 6) AS vs_baseline, round(accuracy / (1.0 / k), 6) AS vs_random,
       CASE WHEN accuracy > 0.45 THEN 'excellent' WHEN accuracy > 0.40 THEN 'good'
            WHEN accuracy > 0.37 THEN 'baseline' ELSE 'below_baseline' END AS band
FROM res, kk""")


# --- tables on disk ------------------------------------------------------------------------

oracle("csv_scan", """SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, substr(sha256(text), 1, 16) AS text_hash, lang, source
FROM documents""")
oracle("table_sink", """SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(doc_id) AS BIGINT) AS ids
FROM documents GROUP BY lang""")
oracle("feature_store", f"""WITH {LAB},
x AS (SELECT doc_id, count(*) AS n_features, round(sum(value), 6) AS value_sum FROM matrix GROUP BY 1)
SELECT l.doc_id, l.label, l.class_id, n_features, value_sum FROM labels l LEFT JOIN x ON l.doc_id = x.doc_id""")
ORACLE["model_store"] = ORACLE["nb_predict"]
oracle("run_history", """WITH n AS (SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM labels) + (SELECT count(*) FROM events) AS n)
SELECT 'count_tables' AS job, 'run-' || k AS run_id, 3 AS steps, 0 AS failed, 'events' AS last_step, 3 - k AS age, n AS rows_seen
FROM n, (VALUES (1), (2)) r(k)""")
oracle("normalize_endpoint", """WITH p AS (SELECT page_id, url_decode(regexp_replace(url, '^https?://[^/]*/?', '')) AS e FROM pages)
SELECT page_id, CASE WHEN e LIKE '/%' THEN e ELSE '/' || e END AS endpoint FROM p""")
