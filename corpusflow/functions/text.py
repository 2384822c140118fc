"""Column expressions for text: cleaning, normalisation, tokens, flags, statistics.

All functions return a ``Column`` built from Spark built-ins (JVM side, inside
whole-stage codegen where the expression supports it).  No Python UDFs.

Regex dialect: Java.  ``\\b``, ``\\w`` and ``\\s`` are ASCII-only in Java unless
``(?U)``; cleaning strips non-ASCII first (``clean_text``), after which Python,
Java and RE2 agree.  Whitespace is spelled as an explicit class so that every
engine uses the same characters.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Symbol spellings applied before non-ASCII characters are removed (in this order).
SYMBOL_WORDS = [
    ("°", " degrees "),
    ("±", " plus/minus "),
    ("×", " x "),
    ("→", " to "),
    ("≤", " less than or equal to "),
    ("≥", " greater than or equal to "),
]
# Curly quotes: mapped to ASCII quotes by default.  With ``legacy_quotes=True``
# they are left to the non-ASCII strip (deleted), which is what the reference
# ends up doing.
CURLY_QUOTES = [("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")]

# Artifact patterns scanned on a sample of texts (matched on lower-cased text, case-insensitive).
ARTIFACT_PATTERNS = {
    "dates": r"\b\d{1,2}[\/\-]\d{1,2}[\/\-]\d{2,4}\b|\b\w+\s+\d{1,2},?\s+\d{4}\b",
    "times": r"\b\d{1,2}:\d{2}\b",
    "doctor_refs": r"\b(dr|doctor|physician|md|m\.d\.)\b",
    "patient_refs": r"\bpatient\b",
    "hospital_refs": r"\bhospital\b",
    "date_labels": r"\b(date|time)\s*[:\-]",
    "phone_numbers": r"\b\d{3}[\-\.\s]?\d{3}[\-\.\s]?\d{4}\b",
    "medical_ids": r"\b[A-Z0-9]{3,}\b",
}

DATE_LABEL_REMOVE = r"\b(date|time)\s*[:\-]\s*[^\s,]+"
PHONE_REMOVE = r"\b\d{3}[\-\.\s]?\d{3}[\-\.\s]?\d{4}\b"
AGGRESSIVE_REMOVE = r"\b(date|time|patient|dr|md|hospital)\s*[:\-]?\s*\S+"

# Dosage abbreviations expanded in this order.
ABBREVIATIONS = [
    (r"\bp\.?o\.?\b", "oral"),
    (r"\bi\.?v\.?\b", "intravenous"),
    (r"\bq\.?i\.?d\.?\b", "daily"),
    (r"\bb\.?i\.?d\.?\b", "twice daily"),
    (r"\bt\.?i\.?d\.?\b", "three times daily"),
    (r"\bprn\b", "as needed"),
    (r"\bstat\b", "immediately"),
]

# Report section words.
SECTION_WORDS = ["subjective", "objective", "assessment", "plan"]

# Token pattern of the TF-IDF vectoriser, and the vectoriser default used by the variants.
TOKEN_PATTERN = r"\b[a-zA-Z][a-zA-Z0-9]*\b"
DEFAULT_TOKEN_PATTERN = r"\b\w\w+\b"
# Finds in any text the tokens that TOKEN_PATTERN finds once the punctuation, non-ASCII letters included, is stripped.
ASCII_TOKEN = r"(?<!\w)[a-zA-Z][a-zA-Z0-9]*+(?!_)"

# Length-category bin edges (right-closed): (0,1608] short, (1608,4011] medium,
# (4011,8000] long, (8000,inf) very_long.
LENGTH_BINS = [1608, 4011, 8000]
LENGTH_LABELS = ["short", "medium", "long", "very_long"]

# ---------------------------------------------------------------------------

# Whitespace as Python's str.split() sees it in ASCII text.
WS_CLASS = r" \t\n\x0B\f\r\x1C-\x1F"
WS_RUN = f"[{WS_CLASS}]+"
# The runs that a replacement by one space changes: all but a single space before a word.
WS_CHANGED = f"(?! [^{WS_CLASS}])[{WS_CLASS}]++"
NON_ASCII = r"[^\x00-\x7F]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _once(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` names it."""
    return F.transform(F.array(c), use)[0]


def collapse_ws(col) -> Column:
    """``' '.join(s.split())``: runs of whitespace to one space, trimmed."""
    return F.trim(F.regexp_replace(_c(col), WS_CHANGED, " "))


def clean_text(col, legacy_quotes: bool = False) -> Column:
    """Symbol spelling, non-ASCII strip, whitespace collapse, repeated ``.!?`` collapse."""
    pairs = SYMBOL_WORDS if legacy_quotes else SYMBOL_WORDS + CURLY_QUOTES

    def ascii_only(c: Column) -> Column:
        for old, new in pairs:
            c = F.replace(c, F.lit(old), F.lit(new))
        return F.regexp_replace(c, NON_ASCII, "")

    # A text of as many bytes as characters is ASCII already.
    c = _once(_c(col), lambda t: F.when(F.length(t) == F.octet_length(t), t).otherwise(ascii_only(t)))
    return F.regexp_replace(collapse_ws(c), r"[.!?]+([.!?])", "$1")


def has_non_ascii(col) -> Column:
    return _c(col).rlike(NON_ASCII)


NEVER = "(?!)"  # a pattern that matches nowhere


def _switched_replace(c: Column, flag, pattern: str, repl: str = "") -> Column:
    """``regexp_replace`` applied when ``flag`` holds.  ``flag`` is a Python bool
    or a boolean Column (e.g. a scalar subquery); a Column flag selects the
    pattern instead of duplicating the expression tree in both branches."""
    if isinstance(flag, bool):
        return F.regexp_replace(c, pattern, repl) if flag else c
    return F.regexp_replace(c, F.when(flag, F.lit(pattern)).otherwise(F.lit(NEVER)), F.lit(repl))


def normalize_conservative(col, remove_date_labels=False, remove_phones=False) -> Column:
    """Lower-case, optional date-label/phone removal, abbreviation expansion,
    then punctuation strip (``strip_punct``).  Null becomes ''.

    The two switches are data-driven in the reference (set when the artifact
    scan found hits): pass booleans or the Columns of ``artifact_switches``.
    """
    return strip_punct(expanded(col, remove_date_labels, remove_phones))


#: Matches where any abbreviation does.  The look-ahead names the letters after ``\\b``: most positions are left after one comparison.
ANY_ABBREVIATION = f"(?=[{''.join(sorted({p[2] for p, _ in ABBREVIATIONS}))}])(?:{'|'.join(p for p, _ in ABBREVIATIONS)})"


def expanded(col, remove_date_labels=False, remove_phones=False) -> Column:
    """``normalize_conservative`` with the punctuation left in; ``ASCII_TOKEN`` finds the same tokens in both."""
    c = F.lower(F.coalesce(_c(col), F.lit("")))
    c = _switched_replace(c, remove_date_labels, "(?=[dt])" + DATE_LABEL_REMOVE)
    c = _switched_replace(c, remove_phones, "(?=[0-9])" + PHONE_REMOVE)

    def spelled(t: Column) -> Column:
        for pattern, full in ABBREVIATIONS:
            t = F.regexp_replace(t, f"(?={pattern[2]}){pattern}", full)
        return t

    if not (isinstance(remove_date_labels, bool) and isinstance(remove_phones, bool)):
        return spelled(c)  # a higher-order function holds no subquery
    # Where no pattern matches, none of the replacements in turn changes anything.
    return _once(c, lambda t: F.when(t.rlike(ANY_ABBREVIATION), spelled(t)).otherwise(t))


def artifact_hits(col, name: str) -> Column:
    """Number of matches of one artifact pattern in the lower-cased text (case-insensitive)."""
    return F.regexp_count(F.lower(F.coalesce(_c(col), F.lit(""))),
                          F.lit("(?i)" + ARTIFACT_PATTERNS[name]))


#: The first letters of the two patterns behind the switches: most positions are left after one comparison.
SWITCH_STARTS = {"date_labels": "(?=[dt])", "phone_numbers": "(?=[0-9])"}


def has_artifact(col, name: str) -> Column:
    """Whether a pattern of ``SWITCH_STARTS`` matches the lower-cased text; stops at the first match."""
    return F.lower(F.coalesce(_c(col), F.lit(""))).rlike(SWITCH_STARTS[name] + ARTIFACT_PATTERNS[name])


def artifact_matches(col, name: str) -> Column:
    """All matches of one artifact pattern in the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit("(?i)" + ARTIFACT_PATTERNS[name]), F.lit(0))


def normalize_aggressive(col) -> Column:
    """Lower-case, drop ``(date|time|patient|dr|md|hospital)[:-]? token``, strip punctuation."""
    c = F.lower(F.coalesce(_c(col), F.lit("")))
    c = F.regexp_replace(c, AGGRESSIVE_REMOVE, "")
    return strip_punct(c)


def strip_punct(col) -> Column:
    """Punctuation to space keeping decimal points, then whitespace collapse; one match per run, in one pass."""
    return F.trim(F.regexp_replace(_c(col), r"(?! \w)(?:[^\w.]++|\.(?!\d))++", " "))


def normalize_simple(col) -> Column:
    """Null to '', lower-case, non-word non-space to space, whitespace collapse."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(_c(col), F.lit(""))), r"(?! \w)\W++", " "))


def combined_text(first, second) -> Column:
    """``trim(first + ' ' + second)`` with nulls as ''."""
    return F.trim(F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "),
                           F.coalesce(_c(second), F.lit(""))))


def word_count(col) -> Column:
    """Number of whitespace-separated words (``len(s.split())``); null -> 0."""
    c = collapse_ws(_c(col))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(c, " "))).cast("long")


def char_length(col) -> Column:
    return F.coalesce(F.length(_c(col)), F.lit(0)).cast("long")


def length_category_label(length_col) -> Column:
    """String label of the length bins; 0 or null -> null (training side)."""
    n = _c(length_col)
    return (F.when(n.isNull() | (n <= 0), F.lit(None).cast("string"))
            .when(n <= LENGTH_BINS[0], F.lit(LENGTH_LABELS[0]))
            .when(n <= LENGTH_BINS[1], F.lit(LENGTH_LABELS[1]))
            .when(n <= LENGTH_BINS[2], F.lit(LENGTH_LABELS[2]))
            .otherwise(F.lit(LENGTH_LABELS[3])))


def length_category_code(length_col) -> Column:
    """Ordinal 0..3 of the length bins; 0 -> short (0), as on the serving side."""
    n = F.coalesce(_c(length_col), F.lit(0))
    return (F.when(n <= LENGTH_BINS[0], F.lit(0))
            .when(n <= LENGTH_BINS[1], F.lit(1))
            .when(n <= LENGTH_BINS[2], F.lit(2))
            .otherwise(F.lit(3))).cast("int")


def section_flag(col, word: str) -> Column:
    return F.coalesce(F.lower(_c(col)).contains(word.lower()), F.lit(False)).cast("int")


def all_caps(col) -> Column:
    """Python ``str.isupper()``: has a cased character and no lower-case one."""
    c = _c(col)
    return (F.upper(c) == c) & (F.lower(c) != c)


def tokens(col, pattern: str = TOKEN_PATTERN) -> Column:
    """Lower-cased regex tokens (vectoriser default for this library)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(pattern), 0)


def whitespace_words(col) -> Column:
    """``s.lower().split()`` as an array (empty for null / blank)."""
    c = collapse_ws(F.lower(_c(col)))
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(c, " "))


def remove_stop_words(arr, stop_words: list[str]) -> Column:
    """Drop stop words from an array column; the list is a literal in the plan."""
    stops = F.array(*[F.lit(w) for w in sorted(set(stop_words))])
    return F.filter(_c(arr), lambda t: ~F.array_contains(stops, t))


def _regex_escape(word: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\-" else ch for ch in word)


def trie_regex(words) -> str:
    """A regex alternation of ``words`` factored as a prefix trie (``a(?:bout|fter)?``),
    so the matcher branches on one character at a time instead of trying
    every word at every position."""
    trie: dict = {}
    for w in set(words):
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node) -> str:
        end = "" in node
        alts = [_regex_escape(ch) + emit(child) for ch, child in sorted(node.items()) if ch != ""]
        if not alts:
            return ""
        body = alts[0] if len(alts) == 1 else "(?:" + "|".join(alts) + ")"
        if end:
            return (body if len(alts) > 1 else "(?:" + body + ")") + "?"
        return body

    return "(?:" + emit(trie) + ")"


def joined_tokens(col, pattern: str = TOKEN_PATTERN, stop_words=None) -> Column:
    """Tokens joined by single spaces, stop words removed.

    Stop words are looked up in one hash set, so no string of all tokens is scanned again.
    """
    found = tokens(col, pattern)
    if stop_words:
        found = F.filter(found, lambda t: ~t.isin(*sorted(set(stop_words))))
    return F.array_join(found, " ")


def word_ngrams_from_joined(joined, n_min: int = 1, n_max: int = 2) -> Column:
    """Word n-grams of a space-joined token string, in document order per n.

    Overlapping n-grams come from a zero-width look-ahead anchored at each
    token start; the capture group is the n-gram.
    """
    j = _c(joined)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(F.when(j == "", F.array().cast("array<string>")).otherwise(F.split(j, " ")))
        else:
            parts.append(F.regexp_extract_all(j, F.lit(f"(?<![^ ])(?=([^ ]+(?: [^ ]+){{{n - 1}}}))"), 1))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def word_ngrams(arr, n_min: int = 1, n_max: int = 2) -> Column:
    """Word n-grams of a token array column (see ``word_ngrams_from_joined``)."""
    return word_ngrams_from_joined(F.array_join(_c(arr), " "), n_min, n_max)


def char_ngrams(col, n_min: int = 3, n_max: int = 5) -> Column:
    """Character n-grams of a string, all sizes ``n_min..n_max`` (overlapping look-ahead)."""
    s = F.coalesce(_c(col), F.lit(""))
    parts = [F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) for n in range(n_min, n_max + 1)]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def sha256_prefix(col, n: int = 16) -> Column:
    return F.substring(F.sha2(_c(col), 256), 1, n)


def request_id(ts_col, text_col) -> Column:
    """``md5(str(ts) + text[:50])[:12]``; the time is taken from a column."""
    return F.substring(F.md5(F.concat(_c(ts_col).cast("string"),
                                      F.substring(_c(text_col), 1, 50))), 1, 12)


def text_stats(col) -> Column:
    """Drift statistics of a text as a struct (0 on empty text)."""
    c = F.coalesce(_c(col), F.lit(""))
    n = F.length(c)
    cw = collapse_ws(c)
    words = F.when(cw == "", F.array().cast("array<string>")).otherwise(F.split(cw, " "))
    nw = F.size(words)
    word_chars = F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w))
    distinct_chars = F.size(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("(?s)."), 0)))
    upper = n - F.length(F.regexp_replace(c, r"\p{Lu}", ""))
    digits = n - F.length(F.regexp_replace(c, r"\p{Nd}", ""))
    punct = n - F.length(F.regexp_replace(c, f"[^\\p{{L}}\\p{{N}}{WS_CLASS}]", ""))

    def ratio(x):
        return F.when(n > 0, x / n).otherwise(F.lit(0.0))

    return F.struct(
        n.cast("long").alias("text_length"),
        nw.cast("long").alias("word_count"),
        F.when(nw > 0, word_chars / nw).otherwise(F.lit(0.0)).alias("avg_word_length"),
        ratio(distinct_chars).alias("char_diversity"),
        ratio(upper).alias("uppercase_ratio"),
        ratio(digits).alias("digit_ratio"),
        ratio(punct).alias("punctuation_ratio"),
    )


def normalize_endpoint(c: Column) -> Column:
    """URL-decoded endpoint name with a leading slash; a name that does not decode stays as it is."""
    # url_decode reads '+' as a space; a path's '+' is itself.
    plain = F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    return F.when(F.startswith(plain, F.lit("/")), plain).otherwise(F.concat(F.lit("/"), plain))
