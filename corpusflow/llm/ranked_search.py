"""Ranked lexical search: NRA (no random access) over impact-sorted lists.

A document's score is the sum of its impacts over the item's terms, in integers
(``Statistics``).  The k best documents of every item are found exactly:

1. The items are cut into blocks of about ``BLOCK_TERMS`` terms by hash, and every block is
   searched against all documents.
2. One pass over the texts keeps, per document, its length and the counts of the
   block's terms; the numbers of documents and terms and the documents per term
   are aggregates of that table.
3. Shards: each task reads its part of the table in order and closes a shard
   after about ``SHARD_POSTINGS`` postings, so texts and postings are never
   shuffled and a shard's size does not grow with the table.  A shard's lists
   are sorted by impact.
4. NRA in a shard: the item's lists are read from the top in step, in runs that
   double.  A document's lower bound is what has been read of it, its upper
   bound adds the impact that each list not yet seen for it has come down to.
   Reading goes on until no document outside of the k can reach them, not even
   a tie, and every document that can has its final score.
5. The k best of an item are the best of its shards' k best; ranks are cut
   in every task before they meet.

Defined cases: a null or empty text has no terms and is no result; a null item
text gives no rows; rows of one item_id are one item with all their terms;
repeated document rows are ranked each; equal scores go by doc_id (null first);
fewer matching documents than k give fewer rows; an empty table gives an empty
result; very long texts are read whole; other columns are not read.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import read, ship_package, stored

K, BLOCK_TERMS, SHARD_POSTINGS, FIRST_RUN = 10, 100_000, 2_000_000, 64
#: Fixed value: what separates terms, ``[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]``; A-Z become a-z. Bytes of other characters are above.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def term_column(text: Column) -> Column:
    """The distinct terms of a text, as a column."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({TERM})"), F.lit(1)))


class Statistics:
    """What all documents say about the block's terms; impacts follow from it."""

    def __init__(self, n_docs: int, n_terms: int, df: np.ndarray):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)

    def impacts(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 10 + (90 * length * self.n_docs) // self.n_terms
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Shard:
    """Impact-sorted lists of a bounded number of documents."""

    def __init__(self, doc_ids: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        self.doc_ids, self.doc, self.impact = doc_ids, doc[order], impact[order]
        self.terms, starts = np.unique(term[order], return_index=True)
        self.ends = dict(zip(self.terms.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(term)])))

    def lists(self, wanted: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        spans = [self.ends[t] for t in wanted if t in self.ends]
        return [(self.doc[a:b], self.impact[a:b]) for a, b in spans if self.impact[a] > 0]

    def best(self, wanted: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and scores of the k best documents for these terms, best first."""
        found, scores, _ = nra(self.lists(wanted), self.doc_ids, k)
        return self.doc_ids[found], scores


def nra(lists: list[tuple[np.ndarray, np.ndarray]], doc_ids: np.ndarray, k: int, first_run: int = FIRST_RUN) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, entries read) of the k best sums; ``lists`` hold (document, impact > 0) by falling impact.

    Sums stay below 2**53, so doubles hold them exactly.
    """
    lower = np.zeros(len(doc_ids))
    frontier = np.array([float(impact[0]) for _, impact in lists])
    at, run, entries = 0, first_run, 0
    while True:
        for i, (docs, impact) in enumerate(lists):
            if at < len(docs):
                d, x = docs[at:at + run], impact[at:at + run]
                lower[d] += x
                entries += len(d)
                frontier[i] = x[-1] if at + run < len(docs) else 0.0
        at, run = at + run, run * 2
        unseen = frontier.sum()
        kth = np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else 0.0
        # Documents that can still reach the k-th score; ties count, they are settled by doc_id.
        if unseen and unseen >= kth:
            continue
        missing = np.full(len(doc_ids), unseen)
        for (docs, _), come_down_to in zip(lists, frontier):
            if come_down_to:
                missing[docs[:at]] -= come_down_to
        can = np.flatnonzero((lower > 0) & (lower + missing >= kth))
        if (missing[can] == 0).all():
            order = np.lexsort((doc_ids[can], -lower[can]))[:k]
            return can[order], lower[can][order].astype(np.int64), entries


def items_of(items: DataFrame) -> DataFrame:
    """(item_id, terms, block): one row per item."""
    each = items.select("item_id", F.explode(term_column(F.col("text"))).alias("term")).distinct()
    each = stored(each.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")), "items")
    blocks = -(-(each.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS)
    return each.withColumn("block", F.pmod(F.xxhash64(F.lit(41), "item_id"), F.lit(max(1, blocks))).cast("int"))


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms in the text), ids and tfs (of the vocabulary's terms) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in found:
            n, ids, tfs = [], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                held = {known[w]: c for w, c in Counter(words).items() if w in known}
                n.append(len(words))
                ids.append(list(held))
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                                             names=["doc_id", "n", "ids", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, ids array<int>, tfs array<int>")


def shard_best(counts: DataFrame, statistics: Statistics, wanted: list[list[int]], k: int, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item, doc_id, score): every shard's k best documents of every item; ``wanted`` holds the items' term ids."""
    shared = counts.sparkSession.sparkContext.broadcast((statistics, wanted))

    def searched(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, tfs = table.column("ids").combine_chunks(), table.column("tfs").combine_chunks()
        sizes = np.diff(ids.offsets.to_numpy())
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        term = ids.flatten().to_numpy()
        length = table.column("n").to_numpy()
        doc_ids = table.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
        how, items = shared.value
        shard = Shard(doc_ids, term, doc, how.impacts(term, tfs.flatten().to_numpy().astype(np.int64), length[doc]))
        at, found, scores = [], [], []
        for j, own in enumerate(items):
            best, score = shard.best(own, k)
            at.append(np.full(len(best), j, dtype=np.int32))
            found.append(best)
            scores.append(score)
        found = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(at)), pa.array(found, mask=found == np.iinfo(np.int64).min), pa.array(np.concatenate(scores))],
                                          names=["item", "doc_id", "score"])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings = [], 0
        for batch in found:
            for begin in range(0, batch.num_rows, 1_000):
                part = batch.slice(begin, 1_000)
                held.append(part)
                postings += len(part.column("ids").flatten())
                if postings >= shard_postings:
                    yield searched(held)
                    held, postings = [], 0
        if held:
            yield searched(held)

    return counts.where("n > 0").select(F.col("doc_id").cast("long"), "n", "ids", "tfs").mapInArrow(run, "item int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = K, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    items = stored(items_of(items), "blocks")
    out = None
    for (block,) in sorted(items.select("block").distinct().collect()):
        own = items.where(F.col("block") == block).orderBy("item_id").collect()  # about BLOCK_TERMS terms
        names = sorted({t for r in own for t in r.terms})
        vocabulary = {t.encode(): j for j, t in enumerate(names)}
        counts = stored(counted(docs, vocabulary), "counts")
        n_docs, n_terms = counts.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(names), dtype=np.int64)
        for r in counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # one row per term of the block
            df[r["id"]] = r["count"]
        wanted = [[vocabulary[t.encode()] for t in r.terms] for r in own]
        best = shard_best(counts, Statistics(n_docs, n_terms, df), wanted, k, shard_postings)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(j, r.item_id) for j, r in enumerate(own)], f"j int, item_id {kind}")
        best = best.join(F.broadcast(ids), F.col("item") == F.col("j")).select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLE = {"op11_ranked_search": rf"""
WITH words AS (
  SELECT rowid AS r, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
docs AS (SELECT r, doc_id, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM docs),
counts AS (SELECT r, term, count(*) AS tf FROM words GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, totals GROUP BY term, big_n),
impacts AS (
  SELECT c.r, d.doc_id, c.term, w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (10 + (90 * d.n * t.big_n) // t.big_l))) AS impact
  FROM counts c JOIN docs d USING (r) JOIN weights w USING (term) CROSS JOIN totals t WHERE c.term IN (SELECT term FROM asked)),
scores AS (SELECT a.item_id, i.r, i.doc_id, sum(i.impact)::BIGINT AS score FROM asked a JOIN impacts i USING (term) GROUP BY ALL),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10"""}
