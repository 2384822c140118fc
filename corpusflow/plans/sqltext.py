"""DuckDB (RE2) twins of the text column expressions, for the oracle queries.

These build SQL text only; they mirror ``corpusflow.functions.text`` so the
oracle computes the same thing with another engine.
"""
from __future__ import annotations

from corpusflow.functions import text as tx


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def collapse_ws(e: str) -> str:
    return f"trim(regexp_replace({e}, {q(tx.WS_RUN)}, ' ', 'g'))"


def clean_text(e: str, legacy_quotes: bool = False) -> str:
    pairs = tx.SYMBOL_WORDS if legacy_quotes else tx.SYMBOL_WORDS + tx.CURLY_QUOTES
    for old, new in pairs:
        e = f"replace({e}, {q(old)}, {q(new)})"
    e = f"regexp_replace({e}, {q(tx.NON_ASCII)}, '', 'g')"
    e = collapse_ws(e)
    return f"regexp_replace({e}, '([.!?]){{2,}}', '\\1', 'g')"


def strip_punct(e: str) -> str:
    e = f"regexp_replace({e}, {q('[^\\w' + tx.WS_CLASS + '.]')}, ' ', 'g')"
    # RE2 has no look-ahead: protect '.' before a digit, drop other dots, restore.
    e = f"regexp_replace({e}, '\\.(\\d)', chr(1) || '\\1', 'g')"
    e = f"replace({e}, '.', ' ')"
    e = f"replace({e}, chr(1), '.')"
    return collapse_ws(e)


def normalize_conservative(e: str, remove_date_labels=False, remove_phones=False) -> str:
    e = f"lower(coalesce({e}, ''))"
    if remove_date_labels:
        e = f"regexp_replace({e}, {q(tx.DATE_LABEL_REMOVE)}, '', 'g')"
    if remove_phones:
        e = f"regexp_replace({e}, {q(tx.PHONE_REMOVE)}, '', 'g')"
    for pattern, full in tx.ABBREVIATIONS:
        e = f"regexp_replace({e}, {q(pattern)}, {q(full)}, 'g')"
    return strip_punct(e)


def normalize_aggressive(e: str) -> str:
    e = f"lower(coalesce({e}, ''))"
    e = f"regexp_replace({e}, {q(tx.AGGRESSIVE_REMOVE)}, '', 'g')"
    return strip_punct(e)


def normalize_simple(e: str) -> str:
    e = f"lower(coalesce({e}, ''))"
    e = f"regexp_replace({e}, {q('[^\\w' + tx.WS_CLASS + ']')}, ' ', 'g')"
    return collapse_ws(e)


def word_count(e: str) -> str:
    c = collapse_ws(e)
    return f"CAST(CASE WHEN coalesce({c}, '') = '' THEN 0 ELSE len(string_split({c}, ' ')) END AS BIGINT)"


def whitespace_words(e: str) -> str:
    c = collapse_ws(f"lower({e})")
    return f"(CASE WHEN coalesce({c}, '') = '' THEN []::VARCHAR[] ELSE string_split({c}, ' ') END)"


def tokens(e: str) -> str:
    return f"regexp_extract_all(lower(coalesce({e}, '')), {q(tx.TOKEN_PATTERN)}, 0)"


def has_non_ascii(e: str) -> str:
    return f"regexp_matches({e}, {q(tx.NON_ASCII)})"


def all_caps(e: str) -> str:
    return f"(upper({e}) = {e} AND lower({e}) <> {e})"


def length_category_code(e: str) -> str:
    b = tx.LENGTH_BINS
    return (f"CAST(CASE WHEN coalesce({e},0) <= {b[0]} THEN 0 WHEN coalesce({e},0) <= {b[1]} THEN 1 "
            f"WHEN coalesce({e},0) <= {b[2]} THEN 2 ELSE 3 END AS INTEGER)")


def length_category_label(e: str) -> str:
    b, lab = tx.LENGTH_BINS, tx.LENGTH_LABELS
    return (f"CASE WHEN {e} IS NULL OR {e} <= 0 THEN NULL WHEN {e} <= {b[0]} THEN '{lab[0]}' "
            f"WHEN {e} <= {b[1]} THEN '{lab[1]}' WHEN {e} <= {b[2]} THEN '{lab[2]}' ELSE '{lab[3]}' END")


def str_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


RAW_DOCS = """raw_docs AS (
  SELECT d.doc_id, concat_ws(' ', d.source, d.lang) AS description, d.source AS medical_specialty,
         d.source AS sample_name, d.text AS transcription, CAST(l.quality AS VARCHAR) AS keywords,
         d.lang
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id)"""


def clean_docs(n_classes=15, min_len=50, max_len=8000, method="keep") -> str:
    """CTEs raw_docs .. clean_docs matching ``clean_pipeline`` on ``labelled_documents``."""
    cap = (f"CASE WHEN length(transcription) > {max_len} THEN substr(transcription, 1, {max_len}) "
           f"ELSE transcription END") if method == "cap" else "transcription"
    where = f"WHERE length(transcription) <= {max_len}" if method == "remove" else ""
    return RAW_DOCS + f""",
  cd_missing AS (SELECT doc_id, description, medical_specialty, sample_name, transcription, lang
                 FROM raw_docs WHERE transcription IS NOT NULL),
  cd_quality AS (SELECT doc_id, description, medical_specialty, sample_name,
                        {clean_text('transcription')} AS transcription, lang
                 FROM cd_missing WHERE length(transcription) >= {min_len}),
  cd_outlier AS (SELECT doc_id, description, medical_specialty, sample_name, {cap} AS transcription, lang
                 FROM cd_quality {where}),
  cd_top AS (SELECT medical_specialty AS k FROM cd_outlier WHERE medical_specialty IS NOT NULL
             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {n_classes}),
  clean_docs AS (SELECT o.doc_id, o.description,
                        CASE WHEN t.k IS NOT NULL THEN o.medical_specialty ELSE 'Other' END AS medical_specialty,
                        o.sample_name, o.transcription, o.lang
                 FROM cd_outlier o LEFT JOIN cd_top t ON o.medical_specialty = t.k)"""
