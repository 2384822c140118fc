"""Text steps of ``functions.text`` for ASCII texts, in Arrow batches.

A Java regex looks at a text character by character, which made the text step of
the features ten times as slow as Python's ``str`` methods are.  Each function
here returns the column that its namesake in ``functions.text`` returns: an ASCII
text is worked on in a batch, any other (and null) by the expression of
``functions.text`` itself, as case, ``\\b`` and white space differ there.
"""
from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions import text as tx

# Patterns begin with a plain character, which the search looks for before it tries anything else.
ENDS = re.compile(rb"[.!?]+([.!?])")
DATE_LABEL = re.compile(tx.DATE_LABEL_REMOVE.encode())
PHONE = re.compile(tx.PHONE_REMOVE.replace(r"\b\d{3}", r"[0-9](?<!\w[0-9])\d{2}", 1).encode())
SWITCHES = {"date_labels": re.compile(tx.ARTIFACT_PATTERNS["date_labels"].encode()), "phone_numbers": PHONE}
ABBREVIATIONS = [(re.compile(p.encode()), full.encode()) for p, full in tx.ABBREVIATIONS]
ANY_ABBREVIATION = re.compile("|".join(f"{p[2]}(?<!\\w{p[2]}){p[3:]}" for p, _ in tx.ABBREVIATIONS).encode())
#: Byte tables: white space to a space, sentence ends to one of them, word characters lower-cased and all others a space.
SPACED = bytes(32 if 9 <= c <= 13 or 28 <= c <= 31 else c for c in range(256))
ENDED = bytes(46 if c in b".!?" else c for c in range(256))
WORDS = bytes(c if c < 128 and (chr(c).isalnum() or c == 95) else 32 for c in range(256)).lower()


def _mapped(column: Column, use: Callable[[bytes], object], to: str) -> Column:
    def run(found: pa.Array) -> pa.Array:
        raw = found.cast(pa.large_binary()).to_pylist()
        return pa.array([None if t is None else use(t) for t in raw], {"string": pa.string(), "boolean": pa.bool_(), "bigint": pa.int64()}[to])

    return F.arrow_udf(run, to)(column)


def _ascii(column: Column, use: Callable[[bytes], object], other: Column, to: str = "string") -> Column:
    """``use`` of a text of as many bytes as characters, else ``other``."""
    own = lambda t: use(t) if t.isascii() else None
    return F.when(F.length(column) == F.octet_length(column), _mapped(column, own, to)).otherwise(other)


def clean_text(col, legacy_quotes: bool = False) -> Column:
    pairs = tx.SYMBOL_WORDS if legacy_quotes else tx.SYMBOL_WORDS + tx.CURLY_QUOTES

    def use(t: bytes) -> bytes:
        if not t.isascii():
            t = t.decode("utf-8", "replace")
            for old, new in pairs:
                t = t.replace(old, new)
            t = t.encode("ascii", "ignore")
        t = t.translate(SPACED)
        while b"  " in t:
            t = t.replace(b"  ", b" ")
        t = t.strip(b" ")
        return ENDS.sub(rb"\1", t) if b".." in t.translate(ENDED) else t

    return _mapped(tx._c(col), use, "string")  # ASCII once its other characters are gone


def has_artifact(col, name: str) -> Column:
    pattern, words = SWITCHES[name], (b"date", b"time") if name == "date_labels" else (b"",)

    def use(t: bytes) -> bool:
        t = t.lower()
        return any(w in t for w in words) and pattern.search(t) is not None

    return _ascii(tx._c(col), use, tx.has_artifact(col, name), "boolean")


def expanded(col, remove_date_labels: bool = False, remove_phones: bool = False) -> Column:
    def use(t: bytes) -> bytes:
        t = t.lower()
        if remove_date_labels and (b"date" in t or b"time" in t):
            t = DATE_LABEL.sub(b"", t)
        if remove_phones:
            t = PHONE.sub(b"", t)
        if ANY_ABBREVIATION.search(t):
            for pattern, full in ABBREVIATIONS:
                t = pattern.sub(full, t)
        return t

    return _ascii(tx._c(col), use, tx.expanded(col, remove_date_labels, remove_phones))


def joined_tokens(col, stop_words=None) -> Column:
    """``functions.text.joined_tokens`` of ``ASCII_TOKEN``: runs of word characters that begin with a letter and hold no ``_``."""
    stops = sorted(set(stop_words or ()))

    def run(found: pa.Array) -> pa.Array:
        rows = pa.array([b"" if t is None else t.translate(WORDS) for t in found.cast(pa.large_binary()).to_pylist()], pa.large_string())
        words = pc.ascii_split_whitespace(rows)
        each, ends = words.flatten(), words.offsets.to_numpy() - words.offsets[0].as_py()
        kept = pc.and_(pc.greater(pc.binary_length(each), 0), pc.invert(pc.is_in(each, pa.array(stops, each.type)))).to_numpy(zero_copy_only=False)
        kept &= pc.greater_equal(pc.utf8_slice_codeunits(each, 0, 1), "a").to_numpy(zero_copy_only=False)
        kept &= ~pc.match_substring(each, "_").to_numpy(zero_copy_only=False)
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(before[ends].astype(np.int32)), each.filter(pa.array(kept))), pa.scalar(" ", each.type)).cast(pa.string())

    column = tx._c(col)
    return F.when(F.length(column) == F.octet_length(column), F.arrow_udf(run, "string")(column)).otherwise(tx.joined_tokens(col, tx.ASCII_TOKEN, stop_words))


def word_count(col) -> Column:
    return _ascii(tx._c(col), lambda t: len(t.translate(SPACED).split()), tx.word_count(col), "bigint")
