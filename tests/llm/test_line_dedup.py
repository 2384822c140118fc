import hashlib
from collections import Counter

import cases
from corpusflow.llm.common import stored
from corpusflow.llm.line_dedup import LineRuns, dedup_lines, hashed_lines, without_common_lines

SPACES = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, min_docs):
    keys = [[lower(line.strip(SPACES)) for line in (t or "").split("\n")] for _, t, *_ in rows]
    n = Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for (doc, text, *_), ks in zip(rows, keys):
        kept = [line for line, k in zip((text or "").split("\n"), ks) if not k or n[k] < min_docs]
        out.append((doc, len(ks), len(ks) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_brute_force_with_awkward_rows(spark):
    for min_docs in (2, 10):
        got = dedup_lines(cases.documents(spark, clashing=True), min_docs=min_docs).collect()
        assert sorted(map(tuple, got), key=str) == brute(cases.rows(), min_docs)


def test_empty_table_and_columns(spark):
    assert dedup_lines(cases.empty(spark)).count() == 0
    docs = cases.documents(spark)
    out = without_common_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_runs_are_compacted_and_survive(spark):
    runs = LineRuns(spark, fanout=2)
    docs = cases.documents(spark)
    for k in range(5):
        runs.add(docs.where(f"doc_id % 5 = {k}"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    whole = LineRuns(spark)
    whole.add(docs.where("doc_id IS NOT NULL"))
    assert sorted(runs.counts().collect()) == sorted(whole.counts().collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batches_meet_the_runs_by_merge_anti_joins(spark):
    docs = cases.documents(spark)
    runs, exact = LineRuns(spark, fanout=2, min_docs=2), LineRuns(spark, fanout=2)
    for k in range(3):
        runs.add(docs.where(f"doc_id % 4 = {k}"))
        exact.add(docs.where(f"doc_id % 4 = {k}"))
    batch = stored(hashed_lines(docs.where("doc_id % 4 = 3"), "doc_id", "text", 1))
    known = {(r.h1, r.h2) for run in runs.runs() for r in run.where("n_docs >= 2").collect()}
    everything = {(r.h1, r.h2): r.n_docs for r in exact.unknown(batch).collect()}
    assert known & set(everything)  # the batch repeats lines that are frequent already
    assert {(r.h1, r.h2): r.n_docs for r in runs.unknown(batch).collect()} == {k: n for k, n in everything.items() if k not in known}
    plan = plan_of(runs.unknown(batch))
    assert plan.count("SortMergeJoin") == len(runs.runs()) and "LeftAnti" in plan and "Broadcast" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch alone
    merged = plan_of(runs.counts())
    assert "FullOuter" in merged and "Exchange" not in merged
    runs.add_hashed(batch)
    exact.add_hashed(batch)
    for least in (1, 2):
        assert ({(r.h1, r.h2) for r in runs.counts().where(f"n_docs >= {least}").collect()}
                == {(r.h1, r.h2) for r in exact.counts().where(f"n_docs >= {least}").collect()})


def test_oracle(spark):
    import duckdb
    from corpusflow.llm.line_dedup import ORACLE, op1_line_dedup
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(ORACLE["op1_line_dedup"]).fetchall())
    assert sorted(map(tuple, op1_line_dedup(spark, sf).collect())) == want
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
