"""Packing: shortest-pack-first over the length histogram.

Every document is tokenised once where it is read, closed with an end id and
cut into pieces of at most ``capacity`` ids.  The histogram of piece lengths has
at most ``capacity`` rows, so the packing is planned on the driver: lengths are
placed longest first, each onto the packs with the most room, as counts of
packing patterns.  A pattern's places are ranges of ranks, and the pieces find
theirs by their rank among the pieces of their length.  Only the pieces' digests
move; texts and ids never do, unless ``with_ids`` asks for them.

Defined cases: a null or empty text is a document of the end id alone; very
long texts are cut into many pieces; rows that repeat a doc_id or a text are
packed each; a null doc_id is carried; an empty table gives an empty result;
other columns are not read.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import numbered, read, ship_package, stored
from corpusflow.llm.word_ids import word_ids

CAPACITY, END_ID, BATCH_BYTES = 2048, 1, 2_000_000
PIECE = "start long, length int, ids_crc32 long, doc_tokens long"


def batches_of(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` characters; a longer text is a run of its own."""
    begin, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield begin, k
            begin, held = k, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(ids), capacity):
        yield start, ids[start:start + capacity]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
           doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids."""
    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(vocabulary)
        for batch in found:
            texts, keys = batch.column(1).to_pylist(), batch.column(0)
            for a, b in batches_of(texts, BATCH_BYTES):
                flat, ends = table.encode_texts(texts[a:b])
                rows: list[tuple] = []
                begin = 0
                for k, end in enumerate(ends):
                    ids = np.append(flat[begin:end], np.uint32(end_id)).astype("<u4")
                    rows += [(a + k, s, len(p), zlib.crc32(p.tobytes()), len(ids), p if with_ids else None) for s, p in cut(ids, capacity)]
                    begin = end
                at, start, length, crc, total, held = zip(*rows)
                columns = [keys.take(pa.array(at)), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                           pa.array(crc, pa.int64()), pa.array(total, pa.int64())]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int32) for p in held], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(columns)])

    return docs.mapInArrow(run, f"doc_id {kind.simpleString()}, {PIECE}" + ", ids array<int>" * with_ids)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Shortest-pack-first: (number of packs, lengths in each) patterns that hold the whole histogram.

    ``room`` maps the space left to the patterns with that space.  Each step
    moves whole counts, so the work follows the number of patterns, not of
    pieces.
    """
    room: dict[int, list[tuple[int, list[int]]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            most = max((r for r in room if r >= length), default=None)
            if most is None:
                count, pattern, space = left, [], capacity
            else:
                count, pattern = room[most].pop()
                space = most
                if not room[most]:
                    del room[most]
                if count > left:
                    room.setdefault(most, []).append((count - left, pattern))
                    count = left
            room.setdefault(space - length, []).append((count, [*pattern, length]))
            left -= count
    return [p for space in sorted(room) for p in room[space]]


def places(patterns: list[tuple[int, list[int]]]) -> dict[int, list[tuple[int, int, int]]]:
    """Per length, the ranges of ranks in order: (end of range, sequence of its first rank minus that rank, offset)."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            own = out.setdefault(length, [])
            begin = own[-1][0] if own else 0
            own.append((begin + count, first - begin, offset))
            offset += length
        first += count
    return out


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (a stored table with ``length``) with sequence_id and offset of every row."""
    spark = parts.sparkSession
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    spots = [(length, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])
             for length, rows in places(plan(histogram, capacity)).items()]
    spots = stored(spark.createDataFrame(spots, "l int, ends array<long>, bases array<long>, offsets array<int>"), "places")
    order = [c for c in ("doc_id", "start", "ids_crc32") if c in parts.columns]
    ranked = numbered(parts, ["length"], order, "__rank").join(spots, F.col("length") == F.col("l"))
    k = F.size(F.filter("ends", lambda e: e <= F.col("__rank")))
    return (ranked.withColumn("__k", k)
            .withColumn("sequence_id", F.get("bases", F.col("__k")) + F.col("__rank"))
            .withColumn("offset", F.get("offsets", F.col("__k")).cast("long"))
            .drop("__rank", "__k", "l", "ends", "bases", "offsets"))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def packed(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, **options) -> DataFrame:
    parts = stored(pieces(docs, vocabulary or default_vocabulary(), capacity, **options), "pieces")
    return pack(parts, capacity)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packed(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                      "sequence_id", "offset")


QUERIES = {"op9_packing": op9_packing}
