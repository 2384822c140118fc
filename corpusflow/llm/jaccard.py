"""N-gram Jaccard join: T-occurrence search with DivideSkip.

A document's set holds its distinct word shingles as 64-bit hashes.  Two sets
link when 100 * intersection >= percent * union.

1. Documents of equal sets (128 bits of hash) form a class; one stands for all.
2. Sets of a size band are cut by token hash into one part more than the most
   tokens that two linked sets of that band can differ in.  Linked sets then
   have a part in common, whole; the hash of a part is an anchor.  A set gives
   the anchors of its own band, and of the next if a partner can be there.
   A band has spare parts for empty ones; a set with more empty parts than that
   gives, for each of them, its prefix tokens (the ``size - least overlap + 1``
   smallest hashes, of which linked sets share one).  So no link is missed.
3. The classes of an anchor are tied to its hub, the one with the smallest hash.
   A hub and the classes tied to it are a search unit: two classes that share an
   anchor share its hub, so they meet there.  Units don't chain, so they do not
   grow into one another.  Only their texts are read again, compressed.
4. Inside a unit, documents are searched against inverted lists: short lists are
   merged by a heap, long ones probed by binary search, and documents with the
   overlap that a link needs are kept and compared exactly.  A unit of more
   than ``UNIT_SHINGLES`` is cut into blocks, and every pair of blocks is searched.
5. Components of the links give each document the smallest doc_id it reaches.

Tokens are 64-bit hashes: two different shingles are taken for one with
probability 2^-64 a pair.

Defined cases: a null or empty text, or one without words, has an empty set and
links with nothing; fewer words than a shingle's make one shingle; very long
texts are read whole; repeated rows are copies; a null doc_id takes part in
links and is never the smallest; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import beside, block_pairs, read, ship_package, stored, worker_cache
from corpusflow.llm.components import components
from corpusflow.llm.occurrence import linked

UNIT_SHINGLES, MAX_WORDS, MAX_SEEN, SAMPLE, HOT = 1_000_000, 200_000, 100_000, 5_000, 20
#: Odd multipliers that mix 64-bit hashes.
MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[3]
    x = (x ^ (x >> np.uint64(27))) * MIX[4]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest
        out = self[word] = xxh3_64_intdigest(word)
        return out


def shingles(text: str | None, width: int) -> np.ndarray:
    """The text's set: sorted distinct hashes of ``width`` words in a row, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    known = worker_cache("word hashes", WordHashes)
    if len(known) > MAX_WORDS:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    if not words:
        return h
    n = min(width, len(words))
    x = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        x = scramble(x + h[k:len(words) - n + 1 + k] + MIX[5])
    return np.unique(x + np.uint64(n))


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(tokens):
        return 0, 0
    total = [int(scramble(tokens * m).sum(dtype=np.uint64)) for m in MIX[:2]]
    both = scramble(np.array(total, dtype=np.uint64) + np.uint64(len(tokens)))
    return tuple(both.astype(np.int64).tolist())


class Bands:
    """Size bands and the parts that sets of a band are cut into, for one similarity."""

    def __init__(self, percent: int, ratio: float = 1.5):
        self.percent, self.ratio = percent, ratio
        self.known: dict[int, tuple[int, int]] = {}

    def start(self, band: int) -> int:
        return -(-int(self.ratio ** band * 1000) // 1000)

    def band(self, size: int) -> int:
        k = 0
        while self.start(k + 1) <= size:
            k += 1
        return k

    def parts(self, band: int) -> tuple[int, int]:
        """(parts, spare): linked sets of the band differ in ``parts - spare - 1`` tokens at most."""
        most = 2 * (self.start(band + 1) - 1) * (100 - self.percent) // (100 + self.percent)
        spare = 0 if most == 0 else 1
        smallest = self.start(band) * self.percent / 100  # of those that give anchors in this band
        while spare and spare <= most:  # until the smallest sets seldom have more empty parts
            n = most + 1 + spare
            empty = n * math.exp(-smallest / n)
            if spare >= empty + 3 * math.sqrt(empty):
                break
            spare += 1
        return most + 1 + spare, spare

    def anchors(self, tokens: np.ndarray) -> np.ndarray:
        size = len(tokens)
        if not size:
            return np.zeros(0, np.int64)
        own = self.band(size)
        bands = [own] + [own + 1] * (size * 100 // self.percent >= self.start(own + 1))
        out = []
        for band in bands:
            if band not in self.known:
                self.known[band] = self.parts(band)
            n, spare = self.known[band]
            salt = scramble(np.array([band * 2 + 1, n], dtype=np.uint64))
            part = (scramble(tokens ^ salt[0]) % np.uint64(n)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            first = np.flatnonzero(np.diff(part[order], prepend=-1))
            sums = np.add.reduceat(scramble(tokens[order] + salt[1]), first)
            held = part[order][first].astype(np.uint64)
            out.append(scramble(sums + held * MIX[0] + salt[0]))
            if n - len(held) > spare:
                prefix = tokens[:size - -(-self.percent * size // 100) + 1]
                for p in np.setdiff1d(np.arange(n, dtype=np.uint64), held) * MIX[1]:
                    out.append(scramble(scramble(prefix + salt[1]) + (salt[:1] ^ p)))
        return np.concatenate(out).astype(np.int64)


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, th (text hash), n, h1 and h2 of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            sets = [shingles(t.as_py(), width) for t in batch.column(2)]
            h1, h2 = zip(*map(digest, sets)) if sets else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in ([len(s) for s in sets], h1, h2)]],
                                             names=["doc_id", "th", "n", "h1", "h2"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, th long, n long, h1 long, h2 long")


def anchors_of(docs: DataFrame, width: int, bands: Bands) -> DataFrame:
    """(h1, anchor) of every set; a task gives those of equal sets once, as far as it remembers (``MAX_SEEN`` sets)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in found:
            for begin in range(0, batch.num_rows, 500):
                sets = {}
                for t in batch.column(0).slice(begin, 500):
                    s = shingles(t.as_py(), width)
                    if len(s) and (h := digest(s)[0]) not in seen:
                        sets[h] = s
                if len(seen) + len(sets) > MAX_SEEN:
                    seen.clear()
                seen.update(sets)
                anchors = [bands.anchors(s) for s in sets.values()] or [np.zeros(0, np.int64)]
                h1 = np.repeat(np.array(list(sets) or [0], dtype=np.int64), [len(a) for a in anchors])
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(np.concatenate(anchors))], names=["h1", "anchor"])

    return docs.select("text").mapInArrow(run, "h1 long, anchor long")


def candidate_units(docs: DataFrame, rows: int, width: int, bands: Bands) -> DataFrame:
    """(unit, h1): every class that shares an anchor with another, with each hub it is tied to; the hub is in its own unit.

    The classes of an anchor are tied to the one with the smallest hash.  Anchors
    that ``HOT`` or more documents of a sample hold get a hub from the sample, and
    their rows are spread by their own hash instead of meeting in one task; the
    sample only decides who meets where, never which edges there are.  It has
    about ``SAMPLE`` documents, so at most ``SAMPLE / HOT`` documents' worth of
    anchors are broadcast.
    """
    drawn = docs.where(F.pmod(F.xxhash64(F.lit(33), "doc_id", F.xxhash64("text")), F.lit(1 << 30)) < SAMPLE * (1 << 30) / max(1, rows))
    hot = anchors_of(drawn, width, bands).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("h1").alias("hub"))
    hot = stored(hot.where(F.col("n") >= HOT).select(F.col("anchor").alias("hot"), "hub"), "hot")
    held = anchors_of(docs, width, bands).join(F.broadcast(hot), F.col("anchor") == F.col("hot"), "left")
    held = held.select(F.when(F.col("hub").isNull(), F.col("anchor")).otherwise(F.xxhash64("anchor", "h1")).alias("key"), "h1", "hub")
    smallest = F.first("h1").over(Window.partitionBy("key").orderBy("h1"))
    edges = held.select(F.col("h1").alias("a"), F.coalesce("hub", smallest).alias("b")).where("a <> b")
    edges = stored(edges.distinct(), "candidates")
    return edges.select(F.col("b").alias("unit"), F.col("a").alias("h1")).unionByName(
        edges.select(F.col("b").alias("unit"), F.col("b").alias("h1")).distinct())


def compressed(docs: DataFrame) -> DataFrame:
    """doc_id, th and the text as a Zstandard frame: what the units' texts are shuffled as."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor
        z = ZstdCompressor(level=3)
        for batch in found:
            for begin in range(0, batch.num_rows, 1_000):
                part = batch.slice(begin, 1_000)
                frames = [z.compress((t.as_py() or "").encode()) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(frames, pa.binary())], names=["doc_id", "th", "frame"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, frame binary")


def searched(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) edges that connect the linked classes of each unit: ``rows`` has unit, i, j and frame."""

    def search(table: pa.Table) -> pa.Table:
        from zstandard import ZstdDecompressor
        z, sets = ZstdDecompressor(), {}
        for t in table.column("frame"):
            s = shingles(z.decompress(t.as_py()).decode(), width)
            sets[digest(s)] = s
        keys = sorted(sets)
        label = linked([sets[k] for k in keys], percent)
        pairs = [(keys[k][0], keys[first][0]) for k, first in enumerate(label) if k != first]
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("unit", "i", "j").applyInArrow(search, "a long, b long")


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """doc_id, th (xxHash64 of the text), n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    ship_package(docs.sparkSession)
    sets = stored(sets_of(docs, width), "sets")
    classes = sets.where("n > 0").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("n").alias("n"))
    classes = stored(classes.select("h1", "h2", "n", F.col("rep.doc_id").alias("r_doc"), F.col("rep.th").alias("r_th")), "classes")
    same = (F.col("th") == F.col("r_th")) & F.col("doc_id").eqNullSafe(F.col("r_doc"))
    units = candidate_units(docs, sets.count(), width, Bands(percent))

    members = stored(classes.join(units, "h1").select(F.col("unit").alias("m_unit"), "h1", "n", "r_doc", "r_th"), "members")
    blocks = members.groupBy("m_unit").agg(F.sum("n").alias("total"))
    blocks = stored(blocks.select(F.col("m_unit").alias("unit"), F.ceil(F.col("total") / unit_shingles).cast("int").alias("blocks")), "units")
    dealt = members.join(blocks, F.col("m_unit") == F.col("unit"))
    own = F.pmod(F.xxhash64(F.lit(31), "h1"), F.col("blocks")).cast("int")
    dealt = stored(dealt.withColumn("own", own).select("unit", "r_doc", "r_th", F.explode(block_pairs()).alias("p"))
                   .select("unit", "p.i", "p.j", "r_doc", "r_th"), "dealt")
    # The candidates grow with the corpus, so they are merged with the texts at every size, not broadcast.
    texts = compressed(docs).join(dealt.hint("merge"), same).select("unit", "i", "j", "frame")
    links = components(stored(searched(texts, width, percent), "links"))

    links = links.select(F.col("node").alias("l_node"), F.col("component").alias("l_root"))
    named = stored(sets.select("doc_id", "th", "n", "h1", "h2").join(links, F.col("h1") == F.col("l_node"), "left").select(
        "doc_id", "th", "n",
        F.when(F.col("n") == 0, F.xxhash64(F.lit(32), "doc_id")).otherwise(F.coalesce("l_root", "h1")).alias("k1"),
        F.when(F.col("n") == 0, F.lit(1)).when(F.col("l_root").isNotNull(), F.lit(0)).otherwise(F.col("h2")).alias("k2")), "named")
    least = stored(named.where("n > 0").groupBy(F.col("k1").alias("g1"), F.col("k2").alias("g2")).agg(F.min("doc_id").alias("least")), "least")
    return named.join(least, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left").select(
        "doc_id", "th", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


@beside
def first_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies: that with the smallest doc_id.

    Rows of that doc_id stay together; in a group without any doc_id all stay.
    """
    found = near_copies(docs, width, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    found = stored(found.select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).distinct(), "first")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__th"))
    return docs.join(found, same, "left_semi").select(*docs.columns)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(read(spark, sf_dir, "documents"), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


QUERIES = {"op10_ngram_jaccard": op10_ngram_jaccard}
