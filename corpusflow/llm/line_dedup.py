"""Line dedup [native]: levelled sorted runs of line hashes.

``LineRuns`` keeps, per line key, the number of documents that hold it, in runs
bucketed and sorted by hash.  Each new batch is merge-anti-joined with the runs:
keys that a run already knows to be frequent are not counted again.  What is
left becomes one run of level 0; ``fanout`` runs of a level are merged into one
of the next, so a key is rewritten only O(log batches) times.  Runs share one
bucketing, so neither the anti-joins nor a merge of two move a run through an
exchange.  (Merges are joins, not unions with a sum: Spark 4.1 takes a columnar
union of bucketed scans for bucketed, which it is not, and leaves keys apart.)

Texts are read twice: once to hash every line into a written table, which feeds
the batches and finds the lines to drop, and once for the result.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
lower-cased, held as 128 bits of xxHash64 (two seeded halves).

Defined cases: a null or empty text is one empty line; lines whose key is
shorter than ``min_chars`` are never dropped; a document of which every line
goes keeps an empty text; every row counts as one document, so rows that repeat
a doc_id or a text count each, and get the same result; a null doc_id stays a
null; columns that are not asked for are not read, whatever their names; an
empty table gives an empty result.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import SPACES, beside, hash128, new_folder, read, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """Per row: document, text hash, and ``__keys``, the (h1, h2, pos) of its lines with a key of ``min_chars`` or more, by hash."""
    keys = F.transform(text_lines(F.col(text)), lambda line, i: F.struct(line_key(line).alias("key"), i.alias("pos")))
    keys = F.filter(keys, lambda k: F.char_length(k["key"]) >= min_chars)

    def both(k: Column) -> Column:
        h1, h2 = hash128(k["key"])
        return F.struct(h1.alias("h1"), h2.alias("h2"), k["pos"].alias("pos"))

    return docs.select(F.col(doc_id).alias("__doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__text"),
                       F.sort_array(F.transform(keys, both)).alias("__keys"))


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Scans of bucketed tables tell the planner their sort order, so that merging runs does not sort them again."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """Runs of (h1, h2, n_docs), each bucketed and sorted by hash.

    With ``min_docs``, a key that one run counts in ``min_docs`` documents or
    more is left out of later batches, so its count stops there; other counts
    are exact.  Without, every count is.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = 2, min_chars: int = 1,
                 min_docs: int | None = None, buckets: int | None = None):
        self.spark, self.fanout, self.min_chars, self.min_docs = spark, fanout, min_chars, min_docs
        self.folder = folder or new_folder(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, level: int, keys: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        with _sorted_scans(self.spark):
            (keys.write.format("parquet").option("path", f"{self.folder}/level={level}/{name}")
             .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name))
        self.levels[level].append(name)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        """The runs merged two at a time: a full merge join of sorted buckets, which holds each key once."""

        def two(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.withColumnRenamed("n_docs", "more").hint("merge")
            return a.join(b, ["h1", "h2"], "full").select(
                "h1", "h2", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"))

        return reduce(two, runs)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Add one batch's run; compact every level that is full."""
        self.add_hashed(stored(hashed_lines(docs, doc_id, text, self.min_chars), "line-hashes"))

    def unknown(self, hashed: DataFrame) -> DataFrame:
        """The batch's keys with their number of documents, without those that a run knows to be frequent."""
        new = F.filter("__keys", lambda k, i: (i == 0) | (F.get("__keys", i - 1)["h1"] != k["h1"]) | (F.get("__keys", i - 1)["h2"] != k["h2"]))
        batch = hashed.select(F.explode(new).alias("k")).groupBy("k.h1", "k.h2").agg(F.count(F.lit(1)).alias("n_docs"))
        if self.min_docs is not None:
            for run in self.runs():
                batch = batch.join(run.where(F.col("n_docs") >= self.min_docs).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return batch

    def add_hashed(self, hashed: DataFrame) -> None:
        """``add`` for a stored table of ``hashed_lines``."""
        self._write(0, self.unknown(hashed))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full = self.levels[level]
            self._write(level + 1, self._merge([self.spark.table(name) for name in full]))
            self.levels[level] = []
            for name in full:
                self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def counts(self) -> DataFrame:
        """All keys with their number of documents, over every run."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, n_docs long")
        return self._merge(runs)

    def drop_frequent(self, docs: DataFrame, min_docs: int, doc_id: str = "doc_id", text: str = "text",
                      carry: tuple[str, ...] = (), hashed: DataFrame | None = None) -> DataFrame:
        """Documents without the lines whose key lies in ``min_docs`` or more documents of the runs.

        Returns doc_id, n_lines, n_dropped, kept_text and the ``carry`` columns.
        ``hashed`` is the stored ``hashed_lines`` of ``docs``, where the caller
        has it.  Only the positions of dropped lines are grouped; each text is
        moved once, to meet those of its own.
        """
        if self.min_docs is not None and min_docs > self.min_docs:
            raise ValueError(f"the runs count documents up to {self.min_docs} only")
        frequent = stored(self.counts().where(F.col("n_docs") >= min_docs).select("h1", "h2"), "frequent-lines")
        if hashed is None:
            hashed = stored(hashed_lines(docs, doc_id, text, self.min_chars), "line-hashes")
        lines = hashed.select("__doc", "__text", F.explode("__keys").alias("__k")).select("__doc", "__text", "__k.h1", "__k.h2", "__k.pos")
        gone = lines.join(frequent, ["h1", "h2"], "left_semi").groupBy(F.col("__doc").alias("__g_doc"), F.col("__text").alias("__g_text")).agg(
            F.collect_set("pos").alias("__gone"))
        whole = docs.select(F.col(doc_id).alias("__doc"), F.coalesce(F.col(text), F.lit("")).alias("__body"),
                            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__text"),
                            *[F.col(c).alias(f"__c_{c}") for c in carry])
        met = whole.join(gone, (F.col("__text") == F.col("__g_text")) & F.col("__doc").eqNullSafe(F.col("__g_doc")), "left")
        rows = met.select("__doc", "__body", "__gone", text_lines(F.col("__body")).alias("__lines"), *[f"__c_{c}" for c in carry])
        kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
        return rows.select(
            F.col("__doc").alias(doc_id),
            F.size("__lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("__gone").isNull(), F.col("__body"))
            .otherwise(F.array_join(F.transform(kept, lambda p: F.get("__lines", p)), "\n")).alias("kept_text"),
            *[F.col(f"__c_{c}").alias(c) for c in carry])


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2,
                doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Fill a ``LineRuns`` from ``docs`` in batches, then drop the frequent lines of all of them."""
    spark = docs.sparkSession
    runs = LineRuns(spark, fanout=fanout, min_chars=min_chars, min_docs=min_docs)
    batch = F.pmod(F.xxhash64("__doc", "__text"), F.lit(batches)).cast("int")
    hashed, path = hashed_lines(docs, doc_id, text, min_chars).withColumn("batch", batch), new_folder(spark, "line-hashes")
    hashed.write.partitionBy("batch").parquet(path)
    hashed = spark.read.schema(hashed.schema).parquet(path)
    for b in range(batches):
        runs.add_hashed(hashed.where(F.col("batch") == b))
    return runs.drop_frequent(docs, min_docs, doc_id, text, carry, hashed)


@beside
def without_common_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The documents table with every text free of frequent lines; n_chars follows the text."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = dedup_lines(docs, min_docs=min_docs, carry=carry).withColumnsRenamed({"kept_text": "text"})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op1_line_dedup": op1_line_dedup}

#: CTEs that drop the frequent lines of ``{docs}``; also used by the pipeline's twin.
LINES_SQL = """
lines AS (
  SELECT rid, doc_id, pos, line,
         translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
        FROM (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}))),
frequent AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
marked AS (SELECT l.rid, l.doc_id, l.pos, l.line, f.key IS NOT NULL AS gone FROM lines l LEFT JOIN frequent f ON l.key = f.key),
kept AS (
  SELECT rid, doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept_text
  FROM marked GROUP BY rid, doc_id)
"""
ORACLE = {"op1_line_dedup": "WITH " + LINES_SQL.format(docs="documents")
          + "SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM kept"}
