"""Registered queries against their DuckDB twins on sf0.001 (fast subset) and the entry smoke test."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from corpusflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["class_top_n", "null_profile", "class_tiers", "text_length_stats", "iqr_outliers", "text_quality",
        "clean_pipeline", "reduce_classes", "rolling_kpis", "endpoint_metrics", "error_summary",
        "hourly_trends", "drift_report", "latency_histogram", "input_hash", "text_stats", "vector_stats"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 50 and "word" in df.columns and all(r["word"] for r in rows)


def test_every_query_has_callable():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = entry.queries()[name](spark, SF)
    cols = sdf.columns
    s_rows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=repr)
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    idx = [d_cols.index(c) for c in cols]
    d_rows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert s_rows == d_rows
