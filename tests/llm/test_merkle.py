import hashlib
import zlib

import cases
import duckdb
from corpusflow.llm import merkle
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    doc, text, lang, source, n = row
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)])


def tree(leaves, fanout):
    """Root, and every leaf's path."""
    paths, owner = [[] for _ in leaves], list(range(len(leaves)))
    level = leaves
    while len(level) > 1:
        runs = [level[k:k + fanout] for k in range(0, len(level), fanout)]
        for j, at in enumerate(owner):
            run, slot = runs[at // fanout], at % fanout
            paths[j].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            owner[j] = at // fanout
        level = [h(*run) for run in runs]
    return level[0], paths


def brute(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[s] = (own, *tree([leaf(r) for r in own], fanout))
    root, above = tree([made[s][1] for s in names], fanout) if names else (None, [])
    out = []
    for s, up in zip(names, above):
        own, subroot, paths = made[s]
        for row, path in zip(own, paths):
            path = path + up
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf(row, lower=hit)
            for left, right in path:
                node = h(left, node, right)
            out.append((row[0], leaf(row), subroot, root, h(*[x + y for x, y in path]), node, node == root))
    return sorted(out, key=str)


def got(docs, fanout=16):
    changed = [F.translate("text", merkle.UPPER, merkle.LOWER) if c == "text" else F.col(c) for c in merkle.FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    made = merkle.manifest(docs, carry={"tampered": F.when(hit, merkle.leaf_hash(changed))}, fanout=fanout)
    made = made.withColumn("folded", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    made = made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), "folded", F.col("folded") == F.col("root"))
    return sorted(map(tuple, made.collect()), key=str)


def test_brute_force_with_awkward_rows(spark):
    docs = cases.documents(spark, clashing=True).withColumns({c: F.lit("x") for c in ("g", "o", "slot", "mid", "left", "path", "leaf", "root")})
    assert got(docs) == brute(cases.rows(), 16)


def test_small_fanout_many_levels_and_groups(spark):
    rows = [(k, f"Text {k}", "en", f"s{k % 7}" if k % 2 else "hot", k) for k in range(300)] + [(900, "Alone", None, "z", 5)]
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(13)
    for fanout in (2, 3):
        assert got(docs, fanout) == brute(rows, fanout)


def test_lone_leaf_and_empty_table(spark):
    rows = [(4, "Only", "en", None, 4)]
    assert got(spark.createDataFrame(rows, cases.SCHEMA)) == brute(rows, 16)
    assert brute(rows, 16)[0][1] == brute(rows, 16)[0][3]  # the leaf is the root
    assert got(cases.empty(spark)) == []


def test_a_change_in_any_column_is_found(spark):
    rows = [(k, f"t{k}", "en", "s", k) for k in range(40)]
    made = merkle.manifest(spark.createDataFrame(rows, cases.SCHEMA))
    changed = {0: (0, "t0", "de", "s", 0), 1: (1, "t1", "en", "s", 2), 2: (2, None, "en", "s", 2), 3: (3, "t3", "en", "s", 3)}
    leaves = spark.createDataFrame([(k, leaf(r)) for k, r in changed.items()], "k long, other string")
    out = made.join(leaves, F.col("doc_id") == F.col("k")).select("k", (merkle.folded(F.col("other"), F.col("path")) == F.col("root")).alias("ok"))
    assert dict(map(tuple, out.collect())) == {0: False, 1: False, 2: False, 3: True}


def test_parents_join_needs_no_second_exchange(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = merkle.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") <= 1 and plan.count("Exchange hashpartitioning(g") <= 1


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(merkle.ORACLE["op12_merkle_manifest"]).fetchall())
    assert sorted(map(tuple, merkle.op12_merkle_manifest(spark, SF).collect())) == want
