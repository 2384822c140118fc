from datetime import datetime

import pytest
from corpusflow.functions import text as tx
from corpusflow.operators import monitor
from corpusflow.sources import store
from corpusflow.streaming import monitor_stream as ms
from pyspark.sql import functions as F


def test_csv_keeps_line_ends_quotes_nulls_and_empty_texts(spark, tmp_path):
    rows = [(1, 'a "quoted", text\nwith lines'), (2, ""), (3, None), (4, " spaces "), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "id long, text string")
    path = store.write_table(df, f"{tmp_path}/t", "csv")
    assert sorted(map(tuple, store.read_csv(spark, path, "id long, text string").collect())) == rows


def test_run_log_records_failures(spark, tmp_path):
    log = store.RunLog(spark, f"{tmp_path}/runs")
    assert log.step("r1", "job", 1, "first", lambda: (3, "x")) == "x"
    with pytest.raises(ZeroDivisionError):
        log.step("r1", "job", 2, "second", lambda: (1 / 0, None))
    row = log.history().first()
    assert (row.steps, row.failed, row.last_step, row.age) == (2, 1, "second", 1)


def test_normalize_endpoint(spark):
    df = spark.createDataFrame([("predict%2Fbatch",), ("/health",), ("a+b",), ("%zz",)], "e string")
    assert [r[0] for r in df.select(tx.normalize_endpoint(F.col("e"))).collect()] == ["/predict/batch", "/health", "/a+b", "/%zz"]


REQUESTS = "event_id long, ts timestamp, endpoint string, status_code int, response_time_ms double"


def requests(spark, minutes):
    return spark.createDataFrame([(k, datetime(2024, 1, 1, 0, 0) if m == 0 else datetime(2024, 1, 1, m // 60, m % 60), "/p", 500 if k % 2 else 200, 10.0)
                                  for k, m in enumerate(minutes)], REQUESTS)


def test_reports_see_nothing_after_as_of(spark):
    log = requests(spark, [0, 10, 20, 200, 210, 220])
    row = monitor.rolling_kpis(log, 60, as_of="2024-01-01 00:30:00").first()
    assert (row.total_requests, row.total_errors, row.window_requests) == (3, 1, 3)
    assert monitor.recent_errors(log, as_of="2024-01-01 00:30:00").count() == 1
    pred = spark.createDataFrame([(k, datetime(2024, 1, 1, k), 0.9 if k < 5 else 0.1, "c", "v") for k in range(10)],
                                 "seq long, ts timestamp, confidence double, prediction string, model_version string")
    early = monitor.drift_report(pred, 5, as_of="2024-01-01 04:00:00").first()
    assert (early.status, early.confidence_mean) == ("analyzed", 0.9)
    assert monitor.drift_report(pred, 6, as_of="2024-01-01 04:00:00").first().status == "insufficient_data"


def test_alerts_on_a_short_log(spark):
    assert monitor.alert_windows(requests(spark, [0, 1, 2]), quiet_minutes=10).count() == 0


def test_stream_resumes_and_equals_batch(spark, tmp_path):
    schema = "model_version string, preprocessing_time_ms double, prediction_time_ms double, confidence double"
    spark.createDataFrame([("v1", 1.0, 2.0, 0.5)], schema).write.parquet(f"{tmp_path}/in/a")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    run = tmp_path.name
    assert ms.run_to_table(stream(), "rows", run=run).count() == 1
    spark.createDataFrame([("v1", 3.0, 4.0, 0.7), ("v2", 1.0, 1.0, 0.1)], schema).write.parquet(f"{tmp_path}/in/b")
    both = ms.run_to_table(stream(), "rows", run=run)
    assert sorted(map(tuple, both.collect())) == [("v1", 1.0, 2.0, 0.5), ("v1", 3.0, 4.0, 0.7), ("v2", 1.0, 1.0, 0.1)]
    running = ms.run_to_table(ms.running_perf(stream()), "perf", mode="complete")
    batch = ms.running_perf(spark.read.schema(schema).parquet(f"{tmp_path}/in/*"))
    assert sorted(map(tuple, running.collect())) == sorted(map(tuple, batch.collect()))


def test_linear_percentiles_equal_percentile(spark):
    import random
    from corpusflow.functions.stats import linear_percentiles
    rng = random.Random(8)
    rows = [(rng.choice([7, rng.randrange(50), rng.randrange(2 ** 31)]), rng.randrange(3) if k % 4 else None, None) for k in range(999)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(7)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r.name: r.percentiles for r in linear_percentiles(df, {x: F.col(x) for x in "abc"}, ps).collect()}
    for x in "ab":
        assert [got[x][p] for p in ps] == df.select(F.percentile(x, ps)).first()[0]
    assert "c" not in got  # no values
    one = spark.createDataFrame([(5,)], "a int")
    assert [r.percentiles for r in linear_percentiles(one, {"a": F.col("a")}, [0.3]).collect()] == [{0.3: 5.0}]


def test_bucketed_feature_tables_join_without_exchange(spark, tmp_path):
    class Made:
        matrix = spark.createDataFrame([(k % 50, f"f{k}", float(k)) for k in range(500)], "doc_id long, feature string, value double")
        labels = spark.createDataFrame([(k, f"c{k % 3}") for k in range(60)], "doc_id long, label string")
        vocab = spark.createDataFrame([("a", 1)], "term string, df long")

    kept = store.FeatureStore(spark, f"{tmp_path}/s", buckets=4).save(Made, ("matrix", "labels", "vocab"))
    again = store.FeatureStore(spark, f"{tmp_path}/s", buckets=9)  # the layout on disk counts
    for name in ("matrix", "labels"):
        spark.sql(f"DROP TABLE {kept._table(name)}")  # as in a new session
        assert again.load(name).exceptAll(getattr(Made, name)).isEmpty() and again.load(name).count() == getattr(Made, name).count()
    assert again.load("vocab").collect() == Made.vocab.collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = again.load("labels").join(again.load("matrix").groupBy("doc_id").agg(F.sum("value").alias("v")), "doc_id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 60 and joined.filter("v is null").count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_prediction_log_rows_hold_every_field(spark, tmp_path):
    from corpusflow.operators import score as sc
    from corpusflow.sources import logs
    texts = spark.createDataFrame([(1, "Patient presents with acute chest pain.", datetime(2024, 1, 1)), (2, "x" * 600, datetime(2024, 1, 2))], "doc_id long, text string, ts timestamp")
    pred = spark.createDataFrame([(1, 0, 0.9, [(0, 0.9), (1, 0.1)]), (2, 1, 0.6, [(1, 0.6), (0, 0.4)])],
                                 "doc_id long, pred_class_id long, confidence double, top array<struct<class_id:long,confidence:double>>")
    index = spark.createDataFrame([("de", 0), ("en", 1)], "label string, label_id long")
    rows = sc.prediction_log_rows(texts, pred, index, preprocessing_ms=2.0, prediction_ms=1.5)
    assert rows.columns == ["doc_id", *[f.name for f in logs.PREDICTION_SCHEMA]]
    assert not [f.name for f in logs.PREDICTION_SCHEMA if rows.schema[f.name].dataType != f.dataType and f.name not in ("top_predictions", "feature_stats")]
    for _ in range(2):
        store.write_table(rows, f"{tmp_path}/log", mode="append")
    got = spark.read.parquet(f"{tmp_path}/log").orderBy("doc_id").collect()
    assert len(got) == 4 and got[0].prediction == "de" and got[0].total_time_ms == 3.5 and len(got[3].input_text) == 500 and got[3].input_length == 600
    assert [(t["class"], t.confidence) for t in got[3].top_predictions] == [("en", 0.6), ("de", 0.4)]
    assert got[0].feature_stats["text_length"] == 39 and got[0].feature_stats["word_count"] == 6


def test_counters_and_error_counts(spark):
    log = requests(spark, [0, 1, 2])
    pred = spark.createDataFrame([("v1", 0.9, 1.0, 1.0), ("v1", 0.5, 1.0, 1.0), ("v2", 0.1, 1.0, 1.0)],
                                 "model_version string, confidence double, preprocessing_time_ms double, prediction_time_ms double")
    got = {(r.counter, r.key): r.n for r in monitor.log_counters(log, pred).collect()}
    assert got == {("status_code", "200"): 2, ("status_code", "500"): 1, ("endpoint", "/p"): 3, ("errors", ""): 1, ("model_version", "v1"): 2,
                   ("model_version", "v2"): 1, ("low_confidence", "v1"): 1, ("low_confidence", "v2"): 1}
    failed = spark.createDataFrame([("v1",), ("v1",)], "model_version string")
    assert {r.model_version: r.error_count for r in monitor.prediction_perf(pred, errors=failed).collect()} == {"v1": 2, "v2": 0}
    raw = spark.createDataFrame([("ERROR", "prediction_error"), ("ERROR", "other"), ("INFO", "prediction_error")], "level string, event_type string")
    assert monitor.prediction_errors(raw).count() == 1
