"""Character n-grams counted and weighed in blocks of documents, from their texts (column ``j``).

As ``term_blocks`` does for words: a task numbers the distinct n-grams of a block,
each size from the one before, so an n-gram of any length is one number and only
what is passed on becomes a string.  Characters are code points (the regex of
``functions.text`` cuts one beyond U+FFFF in two; the queries' texts hold none).
Rows are whole documents.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from corpusflow.operators.term_blocks import VECTOR

#: Characters that a task holds at a time.
BLOCK_CHARS = 1_000_000


def _numbered() -> Callable:
    def run(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of each key, the distinct keys in order); all keys are below ``most``."""
        if most > max(1 << 21, 8 * len(keys)):
            distinct, number = np.unique(keys, return_inverse=True)
            return number, distinct
        held = np.zeros(most, bool)
        held[keys] = True
        distinct = np.flatnonzero(held)
        number = np.zeros(most, np.int32)
        number[distinct] = np.arange(len(distinct))
        return number[keys], distinct

    return run


def _grams() -> Callable:
    """Iterates over the blocks of a batch and their sizes of n-grams; made here, so that it is sent to the tasks by value."""
    most, numbered = BLOCK_CHARS, _numbered()

    def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(characters of each text, code point of every one)"""
        if all(map(bytes.isascii, texts)):
            return np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8)
        wide = [t.decode("utf-8", "replace").encode("utf-32-le") for t in texts]
        return np.array([len(t) // 4 for t in wide], np.int64), np.frombuffer(b"".join(wide), np.uint32)

    def sized(sizes: np.ndarray, ids: np.ndarray, alphabet: np.ndarray, ngram: tuple) -> Iterator[tuple]:
        """(size, where n-grams begin, the number of each, code points and a hash of each distinct one)"""
        at = np.arange(len(ids))
        left = np.repeat(np.cumsum(sizes), sizes) - at
        key, grams, hashes = ids, alphabet[:, None], None
        for n in range(1, ngram[1] + 1):
            if n > 1:
                whole = left[at] >= n
                at = at[whole]
                key, distinct = numbered(key[whole].astype(np.int64) * len(alphabet) + ids[at + n - 1], len(grams) * len(alphabet))
                grams = np.concatenate([grams[distinct // len(alphabet)], alphabet[distinct % len(alphabet)][:, None]], axis=1)
            if n >= ngram[0]:
                hashes = np.zeros(len(grams), np.uint64)
                for k in range(n):
                    hashes = (hashes ^ (grams[:, k].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
                    hashes ^= hashes >> np.uint64(29)
                yield n, at, key, grams, hashes

    def run(batch: pa.RecordBatch, ngram: tuple) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Iterator]]:
        """(rows, the document of every character, their ``sized`` n-grams)"""
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("j")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, side="right")))
            rows = batch.slice(begin, end - begin)
            sizes, codes = codes_of([t or b"" for t in rows.column("j").cast(pa.large_binary()).to_pylist()])
            ids, alphabet = numbered(codes, 0x110000)
            yield rows, np.repeat(np.arange(len(sizes)), sizes), sized(sizes, ids, alphabet, ngram)
            begin = end

    return run


def _strings() -> Callable:
    def run(grams: np.ndarray) -> list[str]:
        """The n-grams whose code points are the rows."""
        n, text = grams.shape[1], grams.astype("<u4").tobytes().decode("utf-32-le")
        return [text[i:i + n] for i in range(0, len(text), n)]

    return run


def _fold_of() -> Callable:
    def run(rows: pa.RecordBatch, folds: tuple) -> np.ndarray | None:
        """The place of each row's fold in ``folds``, else -1."""
        return np.array([-1 if j not in folds else folds.index(j) for j in rows.column("fold").to_pylist()]) if folds else None

    return run


def bucket_sums(rows: DataFrame, ngram: tuple, buckets: int, folds: tuple = ()) -> DataFrame:
    """``(bucket, cf)`` and ``cf_j`` within each of ``folds``: all terms added up in hashed counters."""
    grams, fold_of = _grams(), _fold_of()
    columns = ["cf", *[f"cf_{j}" for j in folds]]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(columns), buckets), np.int64)
        for batch in found:
            for part, owner, sized in grams(batch, ngram):
                fold = fold_of(part, folds)
                for _, at, key, distinct, hashes in sized:
                    to = (hashes & np.uint64(buckets - 1)).astype(np.int64)
                    np.add.at(total[0], to, np.bincount(key, minlength=len(distinct)))
                    for k in range(len(folds)):
                        np.add.at(total[k + 1], to, np.bincount(key[fold[owner[at]] == k], minlength=len(distinct)))
        held = np.flatnonzero(total[0])
        for lo in range(0, len(held), 50_000):
            some = held[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(c[some]) for c in total]], names=["bucket", *columns])

    parts = rows.select("j", *(["fold"] if folds else [])).mapInArrow(run, ", ".join(f"{c} long" for c in ["bucket", *columns]))
    return parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])


def term_stats(rows: DataFrame, ngram: tuple, buckets: int, folds: tuple = (), only: DataFrame | None = None) -> DataFrame:
    """``(term, df, cf)`` and ``df_j``, ``cf_j`` within each of ``folds``; ``only`` names the counters whose terms are counted."""
    grams, fold_of, strings, numbered = _grams(), _fold_of(), _strings(), _numbered()
    columns = ["df", "cf", *[f"{c}_{j}" for j in folds for c in ("df", "cf")]]
    wanted = np.ones(buckets, bool)
    if only is not None:
        wanted[:] = False
        wanted[[r.bucket for r in only.select("bucket").collect()]] = True  # at most ``buckets`` numbers
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = np.unpackbits(shared.value).astype(bool)
        for batch in found:
            for part, owner, sized in grams(batch, ngram):
                fold = fold_of(part, folds)
                for _, at, key, distinct, hashes in sized:
                    kept = chosen[(hashes & np.uint64(buckets - 1)).astype(np.int64)]
                    m, held = int(kept.sum()), kept[key]
                    if not m:
                        continue
                    key, doc = (np.cumsum(kept) - 1)[key[held]], owner[at[held]]
                    once = numbered(doc * m + key, part.num_rows * m)[1]  # a document's distinct terms
                    made = [np.bincount(once % m, minlength=m), np.bincount(key, minlength=m)]
                    for k in range(len(folds)):
                        made += [np.bincount(once[fold[once // m] == k] % m, minlength=m), np.bincount(key[fold[doc] == k], minlength=m)]
                    term = pa.array(strings(distinct[kept]), pa.string())
                    for lo in range(0, m, 50_000):
                        yield pa.RecordBatch.from_arrays([term[lo:lo + 50_000], *[pa.array(c[lo:lo + 50_000]) for c in made]], names=["term", *columns])

    parts = rows.select("j", *(["fold"] if folds else [])).mapInArrow(run, ", ".join(["term string", *[f"{c} long" for c in columns]]))
    return parts.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])


def term_vectors(rows: DataFrame, vocab: list[Row], ngram: tuple, counts_only: bool = False, out: str = "v") -> DataFrame:
    """``rows`` with a sparse vector (``VECTOR``) in place of ``j`` and ``terms``: TF-IDF over a collected vocabulary, or raw counts."""
    grams, strings, d = _grams(), _strings(), len(vocab)
    shared = rows.sparkSession.sparkContext.broadcast(([r.term for r in vocab], None if counts_only else np.array([r.idf for r in vocab])))
    kept = [c for c in rows.columns if c not in ("j", "terms")]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        index = {t: i for i, t in enumerate(terms)}
        # The hashes of the vocabulary's own n-grams tell which n-grams need to be looked up.
        own = {}
        for _, _, made in grams(pa.RecordBatch.from_arrays([pa.array(terms, pa.string())], names=["j"]), ngram):
            for n, _, _, _, hashes in made:
                own[n] = np.concatenate([own.get(n, hashes[:0]), hashes])
        for batch in found:
            for part, owner, sized in grams(batch, ngram):
                cells = []
                for n, at, key, distinct, hashes in sized:
                    near = np.flatnonzero(np.isin(hashes, own.get(n, hashes[:0])))
                    place = np.full(len(distinct), -1, np.int64)
                    place[near] = [index.get(t, -1) for t in strings(distinct[near])]
                    hit = place[key]
                    cells.append(owner[at[hit >= 0]] * d + hit[hit >= 0])
                tf = np.bincount(np.concatenate([*cells, np.zeros(0, np.int64)]), minlength=part.num_rows * d)
                cell = np.flatnonzero(tf)
                doc, i, value = cell // d, cell % d, tf[cell].astype(float)
                if idf is not None:
                    value *= idf[i]
                    value /= np.sqrt(np.bincount(doc, value * value, minlength=part.num_rows))[doc]
                ends = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32))
                vector = pa.StructArray.from_arrays([
                    pa.array(np.zeros(part.num_rows, np.int8)), pa.array(np.full(part.num_rows, d, np.int32)),
                    pa.ListArray.from_arrays(ends, pa.array(i.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(value))], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], vector], names=[*kept, out])

    source = rows.select("j", *kept)
    return source.mapInArrow(run, source.drop("j").schema.add(out, DataType.fromDDL(VECTOR)))
