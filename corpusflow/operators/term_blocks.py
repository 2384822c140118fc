"""Word n-grams counted and weighed in blocks of documents, from their joined tokens (column ``j``).

A task numbers the words of a block of documents, so an n-gram is a few integers
and only what is passed on becomes a string.  Three passes, each returning what its namesake in ``features`` does with
arrays of terms: hashed counters, exact counts of the terms in chosen counters,
sparse vectors over a bounded vocabulary.  Rows are whole documents.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Characters of text that a task holds as words at a time.
BLOCK_CHARS = 2_000_000
#: How a sparse vector is written; ``tinyint`` 0 is MLlib's mark of one.
VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def _blocks() -> Callable:
    """Iterates over runs of a batch's rows with their words; made here, so that it is sent to the tasks by value."""
    most = BLOCK_CHARS

    def run(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
        """(rows, words of each, the number of every word, the distinct words by number)"""
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("j")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
            rows = batch.slice(begin, end - begin)
            words = pc.split_pattern(pc.fill_null(rows.column("j"), ""), " ")
            sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
            each = pc.list_flatten(words)
            none = np.diff(ends[begin:end], prepend=done) == 0  # a text without words comes as one empty word
            if none.any():
                each = each.filter(pa.array(~np.repeat(none, sizes)))
                sizes[none] = 0
            coded = each.dictionary_encode()
            yield rows, sizes, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            begin = end

    return run


def _starts() -> Callable:
    def run(sizes: np.ndarray, n: int) -> np.ndarray:
        """Positions at which ``n`` words of one document begin."""
        at = np.arange(int(sizes.sum()))
        left = np.repeat(np.cumsum(sizes), sizes) - at
        return at[left >= n]

    return run


def _hashed() -> Callable:
    """Hash of every n-gram of a block, the same in all tasks."""

    def run(ids: np.ndarray, hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h = (h ^ hashes[ids[at + k]]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    return run


def _word_hashes() -> Callable:
    def run(names: pa.Array) -> np.ndarray:
        """A hash of each word, the same in all tasks: its bytes as the digits of a number to an odd base."""
        whole = names.cast(pa.large_binary())
        ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
        if not len(whole):
            return np.zeros(0, np.uint64)
        data = np.frombuffer(whole.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64) + np.uint64(1)
        at = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))
        power = np.cumprod(np.full(int(at.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
        return np.add.reduceat(data * power[at], ends[:-1] - ends[0])  # no word is empty

    return run


def bucket_sums(rows: DataFrame, ngram: tuple[int, int], buckets: int, folds: tuple = ()) -> DataFrame:
    """``(bucket, cf)`` and ``cf_j`` within each of ``folds``: all terms added up in hashed counters."""
    blocks, starts, hashed, word_hashes = _blocks(), _starts(), _hashed(), _word_hashes()
    columns = ["cf", *[f"cf_{j}" for j in folds]]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(columns), buckets), np.int64)
        for batch in found:
            for part, sizes, ids, names in blocks(batch):
                hashes = word_hashes(names)
                fold = np.repeat(np.array([-1 if j not in folds else folds.index(j) for j in part.column("fold").to_pylist()]), sizes) if folds else None
                for n in range(ngram[0], ngram[1] + 1):
                    at = starts(sizes, n)
                    to = (hashed(ids, hashes, at, n) & np.uint64(buckets - 1)).astype(np.int64)
                    total[0] += np.bincount(to, minlength=buckets)
                    for k in range(len(folds)):
                        total[k + 1] += np.bincount(to[fold[at] == k], minlength=buckets)
        held = np.flatnonzero(total[0])
        for lo in range(0, len(held), 50_000):
            some = held[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(c[some]) for c in total]], names=["bucket", *columns])

    parts = rows.select("j", *(["fold"] if folds else [])).mapInArrow(run, ", ".join(f"{c} long" for c in ["bucket", *columns]))
    return parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])


def term_stats(rows: DataFrame, ngram: tuple[int, int], buckets: int, folds: tuple = (), only: DataFrame | None = None) -> DataFrame:
    """``(term, df, cf)`` and ``df_j``, ``cf_j`` within each of ``folds``; ``only`` names the counters whose terms are counted."""
    blocks, starts, hashed, word_hashes = _blocks(), _starts(), _hashed(), _word_hashes()
    columns = ["df", "cf", *[f"{c}_{j}" for j in folds for c in ("df", "cf")]]
    wanted = np.ones(buckets, bool)
    if only is not None:
        wanted[:] = False
        wanted[[r.bucket for r in only.select("bucket").collect()]] = True  # at most ``buckets`` numbers
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = np.unpackbits(shared.value).astype(bool)
        for batch in found:
            for part, sizes, ids, names in blocks(batch):
                hashes = word_hashes(names)
                fold = np.array([-1 if j not in folds else folds.index(j) for j in part.column("fold").to_pylist()]) if folds else None
                owner = np.repeat(np.arange(len(sizes)), sizes)
                for n in range(ngram[0], ngram[1] + 1):
                    at = starts(sizes, n)
                    at = at[chosen[(hashed(ids, hashes, at, n) & np.uint64(buckets - 1)).astype(np.int64)]]
                    if not len(at):
                        continue
                    key = ids[at]
                    for k in range(1, n):  # a pair of numbers below 2**31 each; three words are the number of a pair and a word
                        key = (np.unique(key, return_inverse=True)[1] if k > 1 else key) << 31 | ids[at + k]
                    _, first, key = np.unique(key, return_index=True, return_inverse=True)
                    m, doc = len(first), owner[at]
                    once = np.unique(doc * m + key)  # a document's distinct terms
                    made = [np.bincount(once % m, minlength=m), np.bincount(key, minlength=m)]
                    for k in range(len(folds)):
                        made += [np.bincount(once[fold[once // m] == k] % m, minlength=m), np.bincount(key[fold[doc] == k], minlength=m)]
                    term = names.take(pa.array(ids[at[first]]))
                    for k in range(1, n):
                        term = pc.binary_join_element_wise(term, names.take(pa.array(ids[at[first] + k])), " ")
                    for lo in range(0, m, 50_000):
                        yield pa.RecordBatch.from_arrays([term[lo:lo + 50_000].cast(pa.string()), *[pa.array(c[lo:lo + 50_000]) for c in made]], names=["term", *columns])

    parts = rows.select("j", *(["fold"] if folds else [])).mapInArrow(run, ", ".join(["term string", *[f"{c} long" for c in columns]]))
    return parts.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])


def term_vectors(rows: DataFrame, vocab: list[Row], ngram: tuple[int, int], counts_only: bool = False, out: str = "v") -> DataFrame:
    """``rows`` with a sparse vector (``VECTOR``) in place of ``j`` and ``terms``: TF-IDF over a collected vocabulary, or raw counts."""
    blocks, starts = _blocks(), _starts()
    known = {w: k for k, w in enumerate(sorted({w for r in vocab for w in r.term.split(" ")}), 1)}
    width, d = len(known) + 1, len(vocab)
    by_size = {}
    for n in range(ngram[0], ngram[1] + 1):
        held = sorted((sum(known[w] * width ** (n - 1 - k) for k, w in enumerate(r.term.split(" "))), i) for i, r in enumerate(vocab) if r.term.count(" ") == n - 1)
        by_size[n] = np.array([k for k, _ in held], np.int64), np.array([i for _, i in held], np.int64)
    idf = None if counts_only else np.array([r.idf for r in vocab])
    shared = rows.sparkSession.sparkContext.broadcast(([*known], by_size, idf))
    kept = [c for c in rows.columns if c not in ("j", "terms")]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, by_size, idf = shared.value
        known = pa.array(words, pa.string())
        for batch in found:
            for part, sizes, ids, names in blocks(batch):
                ids = (pc.fill_null(pc.index_in(names, known.cast(names.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1)[ids]
                owner, cells = np.repeat(np.arange(len(sizes)), sizes), []
                for n, (keys, index) in by_size.items():
                    at = starts(sizes, n)
                    at = at[np.logical_and.reduce([ids[at + k] > 0 for k in range(n)])]
                    key = np.zeros(len(at), np.int64)
                    for k in range(n):
                        key = key * width + ids[at + k]
                    if len(keys) and len(key):
                        near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                        hit = keys[near] == key
                        cells.append(owner[at[hit]] * d + index[near[hit]])
                cell, tf = np.unique(np.concatenate([*cells, np.zeros(0, np.int64)]), return_counts=True)
                doc, i, value = cell // d, cell % d, tf.astype(float)
                if idf is not None:
                    value *= idf[i]
                    value /= np.sqrt(np.bincount(doc, value * value, minlength=len(sizes)))[doc]
                ends = pa.array(np.searchsorted(doc, np.arange(len(sizes) + 1)).astype(np.int32))
                vector = pa.StructArray.from_arrays([
                    pa.array(np.zeros(len(sizes), np.int8)), pa.array(np.full(len(sizes), d, np.int32)),
                    pa.ListArray.from_arrays(ends, pa.array(i.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(value))], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], vector], names=[*kept, out])

    source = rows.select("j", *kept)
    return source.mapInArrow(run, source.drop("j").schema.add(out, DataType.fromDDL(VECTOR)))
