import subprocess
import sys
from pathlib import Path

import cases
import corpus_pipeline
from corpusflow.llm.common import stored
from pyspark.sql import functions as F
from test_jaccard import brute as groups
from test_line_dedup import brute as lines
from test_scores import toxic_rows

ROOT = Path(__file__).resolve().parents[2]


def test_each_stage_against_brute_force(spark, tmp_path):
    toxic, labels = toxic_rows(n=200)
    rows = cases.rows() + [(k + 1000, *r) for k, *r in toxic]
    spark.createDataFrame([(k + 1000, q, t) for k, q, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = stored(cases.documents(spark, rows))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard", "mixing", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    clean = stored(stages["toxicity"](spark, docs, str(tmp_path)))
    assert clean.columns == docs.columns
    bad = {k + 1000 for k, _, t in labels if t}
    left = {r.doc_id for r in clean.collect()}
    assert len(bad & left) <= 0.05 * len(bad)
    assert len({r[0] for r in rows} - bad - left) <= 2

    kept = stored(stages["line_dedup"](spark, clean, str(tmp_path)))
    before = [tuple(r) for r in clean.collect()]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(((d, t) for d, _, _, t in lines(before, 10)), key=str)

    single = stored(stages["ngram_jaccard"](spark, kept, str(tmp_path)))
    before = [tuple(r) for r in kept.collect()]
    assert {r.doc_id for r in single.collect()} == {doc for doc, _, root in groups(before, 5, 80) if doc == root}

    mixed = stored(stages["mixing"](spark, single, str(tmp_path)))
    assert mixed.columns == docs.columns and mixed.exceptAll(single).isEmpty() and 0 < mixed.count() <= single.count()

    packed = stages["packing"](spark, mixed, str(tmp_path))
    tokens = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in tokens} == {r.doc_id for r in mixed.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()


CLASHES = ("n_lines", "n_dropped", "kept_text", "__score", "__doc", "__th", "__tokens", "__source", "__lang", "__topic", "__weight", "__kept", "a.dot", "line", "key",
           "h1", "component", "unit", "others")


def test_other_columns_come_back_whatever_they_are_called(spark, tmp_path):
    toxic, labels = toxic_rows(n=60)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = cases.documents(spark, cases.rows(30))
    more = [F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for k, c in enumerate(CLASHES)]
    docs, bare = stored(plain.select(*more[:5], "*", *more[5:])), stored(plain)
    for name, stage in corpus_pipeline.STAGES:
        docs, bare = stored(stage(spark, docs, str(tmp_path))), stored(stage(spark, bare, str(tmp_path)))
        if name == "packing":
            assert docs.columns == bare.columns and docs.count() == bare.count()
            continue
        assert docs.columns == [*CLASHES[:5], *plain.columns, *CLASHES[5:]]
        assert docs.select(*plain.columns).exceptAll(bare).isEmpty() and docs.count() == bare.count()
        for r in docs.select("doc_id", *[F.col(f"`{c}`") for c in CLASHES]).collect():
            assert list(r)[1:] == [f"{k}:{'-' if r.doc_id is None else r.doc_id}" for k in range(len(CLASHES))]


def test_empty_documents(spark, tmp_path):
    docs = cases.empty(spark)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)))
        assert docs.count() == 0


def test_entry_without_this_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "corpusflow"):
        subprocess.run(["cp", "-r", ROOT / name, tmp_path], check=True)
    (tmp_path / "corpusflow/llm").rename(tmp_path / "gone")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') and k[2].isdigit() for k in q); assert 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_every_dealt_query_is_registered():
    from corpusflow.llm.registry import QUERIES
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
