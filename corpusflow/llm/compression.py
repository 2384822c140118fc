"""Quality rules: compression bands.

A text's Zstandard ratio (bytes by compressed bytes) says how much of it
repeats.  Ratios are taken over the whole text and over fixed chunks that cover
all of it (the last one ends where the text ends and may overlap the one before),
and each must lie in a band that depends on the length: short texts compress
little, long ones more.  Over a band the text is repetitive, under it incompressible
(noise, encoded data).  A text is kept if its base rules hold, its whole ratio is
in band, and no more than ``BAD_CHUNKS`` of its chunks are out of band.

Texts are read once, row by row, and nothing is shuffled.

Defined cases: a null or empty text has no words, fails the base rules and has
ratio 0; a text below the shortest band's length is judged by its base rules
alone; one shorter than a chunk has no chunks, its whole ratio stands for them;
very long texts are read whole, chunk by chunk; repeated rows get the same
result; a null doc_id is carried; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import read, ship_package

#: Production limits: from this many UTF-8 bytes on, the lowest and highest ratio of a kept text.
BANDS = ((200, 1.0, 2.6), (500, 1.2, 2.9), (1_000, 1.35, 3.2), (2_000, 1.5, 3.4), (4_000, 1.6, 3.6), (16_000, 1.7, 3.9),
         (64_000, 1.7, 4.2))
CHUNK, CHUNK_BAND, BAD_CHUNKS, LEVEL = 4096, (1.5, 3.6), 0.2, 3
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, ratio double, n_chunks long, n_bad_chunks long, reason string")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` (a power of two) words found twice or more.

    Windows are named exactly by doubling: equal pairs of names get one name.
    """
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    names = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    if len(seen) == n:
        return 0
    width = 1
    while width < window:
        names = np.unique(names[:-width] * n + names[width:], return_inverse=True)[1]
        width *= 2
    twice = np.bincount(names)[names] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def band(size: int, bands=BANDS) -> tuple[float, float] | None:
    found = None
    for least, low, high in bands:
        if size >= least:
            found = (low, high)
    return found


def chunked(data: bytes, size: int = CHUNK) -> list[bytes]:
    """Chunks of ``size`` bytes that cover ``data``; none if it is shorter than one."""
    last = len(data) - size
    return [data[k:k + size] for k in [*range(0, last, size), last]] if last >= 0 else []


def judge(text: str | None, compressor) -> tuple:
    """The columns of ``COLUMNS`` for one text."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    # UTF-8 continuation bytes are no code points; the white space that split() drops is one byte each.
    inside = sum(map(len, words))
    chars = inside - (len(data) - len(text or ""))
    lines = [x for x in data.split(b"\n") if x.split()]
    repeats = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
    ratio = len(data) / len(compressor.compress(data)) if data else 0.0
    chunks = chunked(data)
    bad = sum(not CHUNK_BAND[0] <= len(c) / len(compressor.compress(c)) <= CHUNK_BAND[1] for c in chunks)
    limits = band(len(data))
    reason = ("base" if failed else "repetitive" if limits and ratio > limits[1] else "incompressible" if limits and ratio < limits[0]
              else "chunks" if bad > BAD_CHUNKS * len(chunks) else "")
    return (n, chars, symbols, len(lines) - len(set(lines)), repeats, failed, not reason, ratio, len(chunks), bad, reason or None)


def compression_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the columns of ``COLUMNS`` for every row."""
    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in found:
            if batch.num_rows:
                columns = zip(*[judge(t.as_py(), compressor) for t in batch.column(1)])
                arrays = [pa.array(c, t) for c, t in zip(columns, TYPES)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *NAMES])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, {COLUMNS}")


NAMES = re.findall(r"(\w+) \w+", COLUMNS)
TYPES = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}[t] for t in re.findall(r"\w+ (\w+)", COLUMNS)]


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules(read(spark, sf_dir, "documents"))


QUERIES = {"op3_compression_bands": op3_compression_bands}
