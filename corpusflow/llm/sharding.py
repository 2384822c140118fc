"""Sharding: longest-processing-time scheduling of groups that stay together.

Documents of equal text form a group.  Groups are scheduled by size, largest
first, always onto the least loaded shard of a heap.  The heap runs over the
histogram of group sizes, not over the groups: groups of one size bin can be
swapped, so only the number of a bin's groups that each shard gets is decided
on the driver, and the groups pick their shard by their rank inside the bin.
Sizes below ``EXACT`` have a bin each, larger ones 64 bins per doubling: at most
``EXACT + 64 * 50`` bins for any input.  Inside a bin every group counts with the
bin's mean size and is placed as by single steps, however many there are.

Law ``bytes``: shard sizes are near equal.

Defined cases: a null text counts as an empty text (both are one group);
size is the UTF-8 bytes plus 16; rows that repeat a doc_id each take a slot;
rows that equal each other may swap slots; a null doc_id is carried; an empty
table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import hash128, numbered, read, stored

EXACT = 1024


def size_bin(size: Column) -> Column:
    """Bins of one size below ``EXACT``, above of 1/64 of a doubling."""
    return F.when(size < EXACT, size).otherwise(F.floor(F.log2(size.cast("double")) * 64) - 64 * 10 + EXACT).cast("int")


def dealt(loads: list[int], groups: int, size: int) -> list[int]:
    """How many of ``groups`` equal groups each shard gets, if one after the other goes to the least loaded shard.

    Shard s would take its groups at loads L, L + size, L + 2 size, ...; one at a
    time means the smallest ``groups`` of all these loads, ties by shard.  The
    level below which they lie is found by bisection, so the work does not grow
    with the number of groups, and the outcome is that of the single steps.
    """

    def below(level: int) -> list[int]:
        return [max(0, -(-(level - load) // size)) for load in loads]

    low, high = min(loads), max(loads) + (groups + 1) * size  # below(low) holds none, below(high) more than all
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if sum(below(middle)) <= groups else (low, middle)
    got = below(low)
    at_level = [s for s, load in enumerate(loads) if load + got[s] * size == low]
    for s in at_level[:groups - sum(got)]:
        got[s] += 1
    return got


def schedule(bins: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """Per bin, the running total of groups by shard: bin, ends.

    ``bins`` has (bin, groups, bytes).  Longest first, every group goes to the
    least loaded shard: bins of a few groups through a heap, larger ones by ``dealt``.
    """
    loads, out = [0] * shards, []
    for key, groups, total in sorted(bins, reverse=True):
        size = max(1, round(total / groups))
        if groups <= shards:
            got, heap = [0] * shards, [(load, s) for s, load in enumerate(loads)]
            heapq.heapify(heap)
            for _ in range(groups):
                load, s = heap[0]
                got[s] += 1
                heapq.heapreplace(heap, (load + size, s))
        else:
            got = dealt(loads, groups, size)
        loads = [load + n * size for load, n in zip(loads, got)]
        out.append((key, list(accumulate(got))))
    return out


def shard(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; equal texts share a shard."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    h1, h2 = hash128(body)
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("long") + 16).alias("size"),
                              F.crc32(body.cast("binary")).alias("text_crc32"), h1.alias("h1"), h2.alias("h2")), "sizes")
    groups = rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"))
    groups = stored(groups.withColumn("bin", size_bin(F.col("bytes"))), "groups")
    bins = groups.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    plan = schedule([(r.bin, r.n, r.bytes) for r in bins.collect()], shards)
    ends = stored(spark.createDataFrame(plan, "b int, ends array<long>"), "plan")
    ranked = numbered(groups, ["bin"], ["h1", "h2"], "rank")
    placed = stored(ranked.join(ends, F.col("bin") == F.col("b")).select(
        F.col("h1").alias("g1"), F.col("h2").alias("g2"),
        F.size(F.filter("ends", lambda e: e <= F.col("rank"))).cast("int").alias("shard")), "placed")
    rows = rows.join(placed, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).drop("g1", "g2")
    rows = stored(rows, "sharded")
    return numbered(rows, ["shard"], ["doc_id", "h1", "h2"], "slot").drop("h1", "h2")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op8_sharding": op8_sharding}
