"""Merkle dataset manifest: one tree per group of rows, and one tree over the groups.

A leaf is the hash of a row's columns.  The leaves of a group ascend by ``order``
(equal rows by their hash, so their places cannot be told apart); while a level
has more than one node, every ``fanout`` consecutive ones are hashed to a node
of the next.  What remains is the group's subroot; the subroots, in the order of
their groups (null first, bytewise), give the root in the same way.

1. Leaves are hashed where the rows are read; texts do not move.
2. One range shuffle of the leaves orders them.  A row's number inside its
   range plus the rows of the group in earlier ranges is its slot; only the
   counts (one per group and range) are windowed, so a group of any size is
   spread over many tasks.
3. Upwards, a window per run of ``fanout`` slots: ``lead`` columns at fixed
   offsets, masked by slot and run length, give the first child its siblings,
   and its row hashes the parent.  Every level is ``fanout`` times smaller.
4. Downwards, ``lag`` and ``lead`` columns give every node the siblings on its
   left and right; joined with its parent's path on (group, run), which is how
   the window left it.  A leaf's path holds its siblings level by level up to
   the root, so it can be folded again: ``folded``.

Nothing but the number of levels and the root reaches the driver.

Defined cases: a null column is hashed as ``-``, which no value gives; a null
group is a group of its own, ahead of all others; null ``order`` values come
first; repeated rows are leaves of their own; a lone leaf is its subroot and a
lone subroot the root, with an empty path; an empty table gives an empty result;
other columns are not read, so their names cannot clash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import read, stored

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The bits of ``monotonically_increasing_id`` that number a partition's rows.
ROW_BITS = 33


def leaf_hash(columns: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the columns, each as its byte count, ``:`` and value, or ``-`` for null."""

    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``slot`` (from 0, by ``order`` inside the group ``g``) and ``n``, the group's size."""
    by = ["g", *order]
    ranked = stored(nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("mid", F.monotonically_increasing_id()), "ranked")
    ranked = ranked.withColumn("part", F.shiftright("mid", ROW_BITS))
    parts = ranked.groupBy("g", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("mid").alias("first"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("g").alias("s_g"), F.col("part").alias("s_part"), "first",
                          F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
                          F.sum("rows").over(Window.partitionBy("g")).alias("n"))
    starts = stored(starts, "starts")
    return (ranked.join(starts, (F.col("g") == F.col("s_g")) & (F.col("part") == F.col("s_part")))
            .withColumn("slot", F.col("mid") - F.col("first") + F.col("before")).drop("mid", "part", "s_g", "s_part", "first", "before"))


def runs(nodes: DataFrame, fanout: int, *sides: str) -> DataFrame:
    """``nodes`` with ``run`` and the siblings' hashes, concatenated, on the ``left`` or ``right``."""
    at, length = F.col("slot") % fanout, F.least(F.lit(fanout), F.col("n") - F.col("run") * fanout)
    run = Window.partitionBy("g", "run").orderBy("slot")
    made = {"left": [F.when(at >= i, F.lag("h", i).over(run)).otherwise("") for i in range(fanout - 1, 0, -1)],
            "right": [F.when(at + i < length, F.lead("h", i).over(run)).otherwise("") for i in range(1, fanout)]}
    return nodes.withColumn("run", F.expr(f"slot div {fanout}")).withColumns({side: F.concat(*made[side]) for side in sides})


def grown(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The levels of all groups' trees, leaves first: g, slot, n (the group's nodes on that level) and h."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = runs(levels[-1].where("n > 1").select("g", "slot", "n", "h"), fanout, "right").where(F.col("slot") % fanout == 0)
        parents = first.select("g", F.col("run").alias("slot"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                               F.sha2(F.concat("h", "right"), 256).alias("h"))
        levels.append(stored(parents, "level"))
        most = -(-most // fanout)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(g, h): the last node of every group."""
    out = levels[0].where("n = 1").select("g", "h")
    for nodes in levels[1:]:
        out = out.unionByName(nodes.where("n = 1").select("g", "h"))
    return out


def descended(levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """The leaves with ``path`` and ``subroot``; ``above`` (g, path, subroot) holds what lies above each group's top.

    A path is an array of (left, right), one entry per level that was hashed.
    """
    found = None
    for k in reversed(range(len(levels))):
        nodes = levels[k]
        ended = nodes.where("n = 1").select("g").join(above, "g").select(F.col("g").alias("p_g"), F.lit(0).cast("long").alias("p_run"), "path", "subroot")
        up = ended if found is None else ended.unionByName(found.select(F.col("g").alias("p_g"), F.col("slot").alias("p_run"), "path", "subroot"))
        own = runs(nodes, fanout, "left", "right").join(up, (F.col("g") == F.col("p_g")) & (F.col("run") == F.col("p_run")))
        step = F.concat(F.array(F.struct("left", "right")), F.col("path"))
        found = own.withColumn("path", F.when(F.col("n") > 1, step).otherwise(F.col("path"))).drop("left", "right", "p_g", "p_run", "run")
        found = stored(found.select("g", "slot", "path", "subroot"), "paths") if k else found
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hash and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.flatten(F.transform(path, lambda step: F.array(step["left"], step["right"])))), 256)


def manifest(rows: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id",
             carry: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """``order``, leaf, subroot, root and path of every row, and the columns of ``carry``, which are computed beside the leaf."""
    carry = {f"c_{k}": c for k, c in (carry or {}).items()}
    # An order-keeping name of the group that is never null.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = stored(rows.select(key.alias("g"), F.col(order).alias("o"), leaf_hash([F.col(c) for c in fields]).alias("h"),
                                *[c.alias(k) for k, c in carry.items()]), "leaves")
    levels = grown(stored(placed(leaves, ["o", "h"]), "placed"), fanout)

    subroots = tops(levels).select(F.lit("").alias("g"), F.col("g").alias("o"), "h")
    forest = grown(stored(placed(subroots, ["o"]), "subroots"), fanout)
    root = tops(forest).first()
    end = rows.sparkSession.range(1).select(F.lit("").alias("g"), F.lit("").alias("subroot"),
                                            F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = stored(descended(forest, end, fanout).select(F.col("o").alias("g"), "path", F.col("h").alias("subroot")), "above")

    made = descended(levels, above, fanout)
    return made.select(F.col("o").alias(order), F.col("h").alias("leaf"), "subroot", F.lit(root.h if root else None).cast("string").alias("root"),
                       "path", *[F.col(k).alias(k[2:]) for k in carry])


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    changed = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    made = manifest(docs, carry={"tampered": F.when(hit, leaf_hash(changed))})
    made = made.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return made.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle(levels: int = 5, super_levels: int = 3) -> str:
    """DuckDB's twin for groups of up to ``FANOUT ** levels`` rows."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),"
           " lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),"
           " lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
    part = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    leaf = "sha256(" + " || ".join(part.format(c) for c in FIELDS) + ")"
    changed = "sha256(" + " || ".join(part.format(f"translate(text, '{UPPER}', '{LOWER}')" if c == "text" else c) for c in FIELDS) + ")"
    sides = ("coalesce(string_agg(h, '') OVER (PARTITION BY g, slot // 16 ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
             " coalesce(string_agg(h, '') OVER (PARTITION BY g, slot // 16 ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r")
    out = [f"WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf} AS h, CASE WHEN {crc} % 5 = 0 THEN {changed} END AS tampered FROM documents)",
           "a0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS slot, count(*) OVER (PARTITION BY g) AS n FROM d)"]

    def tree(name: str, n: int) -> None:
        for k in range(n):
            out.append(f"{name}s{k} AS (SELECT *, slot // 16 AS run, {sides} FROM {name}{k})")
            out.append(f"{name}{k + 1} AS (SELECT g, run AS slot, (n + 15) // 16 AS n, CASE WHEN n = 1 THEN h ELSE sha256(h || r) END AS h FROM {name}s{k} WHERE slot % 16 = 0)")

    tree("a", levels)
    out.append(f"b0 AS (SELECT '' AS g, g AS key, h, row_number() OVER (ORDER BY g) - 1 AS slot, count(*) OVER () AS n FROM a{levels})")
    tree("b", super_levels)
    steps = [f"as{k}" for k in range(levels)] + [f"bs{k}" for k in range(super_levels)]
    fold = "coalesce(as0.tampered, as0.h)"
    for s in steps:
        fold = f"CASE WHEN {s}.n = 1 THEN {fold} ELSE sha256({s}.l || {fold} || {s}.r) END"
    proof = "sha256(" + " || ".join(f"{s}.l || {s}.r" for s in steps) + ")"
    joins = [f"JOIN as{k} ON as{k}.g = as0.g AND as{k}.slot = as{k - 1}.run" for k in range(1, levels)]
    joins += ["JOIN bs0 ON bs0.key = as0.g", *[f"JOIN bs{k} ON bs{k}.slot = bs{k - 1}.run" for k in range(1, super_levels)], f"CROSS JOIN b{super_levels} AS top"]
    out.append(f"made AS (SELECT as0.doc_id, as0.h AS leaf, bs0.h AS subroot, top.h AS root, {proof} AS proof_sha256, {fold} AS folded_root FROM as0 {' '.join(joins)})")
    return ",\n".join(out) + "\nSELECT *, folded_root = root AS verified FROM made"


QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
ORACLE = {"op12_merkle_manifest": oracle()}
