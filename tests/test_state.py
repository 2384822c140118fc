import datetime as dt
import random

import pytest
from corpusflow.operators import monitor as mon
from corpusflow.streaming import monitor_stream as ms
from corpusflow.streaming import state as st
from pyspark.sql import functions as F

PRED = "seq long, ts timestamp, model_version string, confidence double, prediction string"
REQ = "event_id long, ts timestamp, endpoint string, status_code int, response_time_ms double"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def small(spark):
    """Few state partitions, so that micro-batches are quick."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def predictions(spark, seqs, rng):
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=k // 3), f"v{0 if k % 3 else k % 2 + 1}", rng.random(), rng.choice("abc")) for k in seqs], PRED)


def test_newest_rows_over_batches_and_a_restart(spark, small, tmp_path):
    rng = random.Random(1)
    order = list(range(900))
    random.Random(2).shuffle(order)  # rows come late and out of order
    for b in range(3):
        predictions(spark, order[b * 250:(b + 1) * 250], rng).coalesce(1).write.parquet(f"{tmp_path}/in/a{b}")
    stream = lambda: spark.readStream.schema(PRED).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    run = tmp_path.name

    def check():
        reports = ms.run_to_table(st.newest_predictions(stream(), n=60, window=20, parts=3), "newest", "update", run)
        every = spark.read.schema(PRED).parquet(f"{tmp_path}/in/*")
        latest = st.latest_window(reports, 20)
        drift = {r.model_version: r for r in st.drift_by_version(latest, 20).collect()}
        for (v,) in every.select("model_version").distinct().collect():
            own = every.filter(F.col("model_version") == v)
            want = own.orderBy(F.desc("ts"), F.desc("seq")).limit(20).select("seq").collect()
            assert [r.seq for r in latest.filter(F.col("model_version") == v).orderBy("rank").collect()] == [r.seq for r in want]
            batch = mon.drift_report(own, 20, buffer=60).first()
            assert tuple(drift[v])[1:] == tuple(batch)
        return every.count()

    assert check() == 750
    predictions(spark, order[750:], rng).coalesce(1).write.parquet(f"{tmp_path}/in/b")  # after the restart
    assert check() == 900


def test_too_few_predictions(spark, small, tmp_path):
    predictions(spark, [0, 1, 2], random.Random(1)).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(PRED).parquet(f"{tmp_path}/in")
    drift = st.drift_by_version(st.latest_window(ms.run_to_table(st.newest_predictions(stream, 10, 5), "few", "update"), 5), 5)
    assert {r.status for r in drift.collect()} == {"insufficient_data"}


def requests(spark, minutes, endpoint="/p"):
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m, seconds=k % 50), endpoint, 500 if k % 3 else 200, float(k % 90)) for k, m in enumerate(minutes)], REQ)


def batch_alerts(log, closed, kinds, **kw):
    """Of the batch report over what the watermark has closed, minutes and windows that have ended."""
    out = mon.alert_windows(log.filter(F.col("ts") < closed), as_of=closed.strftime("%Y-%m-%d %H:%M:%S"), **kw).collect()
    return sorted((r.alert, r.start) for r in out if r.alert in kinds)


def told(table, key=None):
    rows = table.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss")).collect()
    return sorted((r.alert, r.start) for r in rows if key is None or r.key == key)


def test_quiet_minutes_are_told_once_and_equal_the_batch(spark, small, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rng = random.Random(3)
    first = sorted(rng.sample(range(0, 300), 40))
    second = sorted(rng.sample(range(330, 700), 30))
    requests(spark, first).coalesce(1).write.parquet(f"{tmp_path}/in/a")
    stream = lambda: spark.readStream.schema(REQ).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    run = tmp_path.name

    def check(minutes):
        got = told(ms.run_to_table(st.quiet_alerts(stream(), delay="30 minutes"), "quiet", run=run))
        log = requests(spark, minutes)
        latest = max(m for m in minutes) - 30
        # Closed: whole minutes before the watermark, whatever the seconds of the last request.
        closed = (log.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=30)).replace(second=0)
        active = {m for m in minutes if m < latest}
        want = [m for m in range(min(active) + 9, latest) if not any(a in active for a in range(m - 9, m + 1))]
        assert got == [("LOW_TRAFFIC", str(T0 + dt.timedelta(minutes=m))) for m in want] and len(set(got)) == len(got)
        # The batch calendar ends at the last active minute.
        end = max(active)
        assert [g for g in got if g[1] <= str(T0 + dt.timedelta(minutes=end))] == batch_alerts(log, closed, {"LOW_TRAFFIC"})

    check(first)
    requests(spark, second).coalesce(1).write.parquet(f"{tmp_path}/in/b")
    got = told(ms.run_to_table(st.quiet_alerts(stream(), delay="30 minutes"), "quiet", run=run))
    active = {m for m in first + second if m < max(second) - 30}
    want = [m for m in range(min(active) + 9, max(second) - 30) if not any(a in active for a in range(m - 9, m + 1))]
    assert got == [("LOW_TRAFFIC", str(T0 + dt.timedelta(minutes=m))) for m in want]


def test_absence_of_one_endpoint_while_others_go_on(spark, small, tmp_path):
    requests(spark, range(0, 60, 5), "/a").union(requests(spark, range(0, 3000, 5), "/b")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(REQ).parquet(f"{tmp_path}/in")
    table = ms.run_to_table(st.quiet_alerts(stream, F.col("endpoint"), absent_hours=23.0), "absent")
    absent = table.filter("alert = 'ABSENT'").collect()
    last = requests(spark, range(0, 60, 5), "/a").agg(F.max("ts")).first()[0]
    assert [(r.key, r.start) for r in absent] == [("/a", last)] and absent[0].value > 23
    assert told(table, "/b") == []


def test_bursts_equal_the_batch(spark, small, tmp_path):
    minutes = sorted(random.Random(5).choices(range(0, 400), k=1500))
    log = requests(spark, minutes)
    log.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(REQ).parquet(f"{tmp_path}/in")
    got = ms.run_to_table(st.burst_alerts(stream, p95_ms=70.0), "bursts").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
    closed = log.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    windows = {}
    for r in log.collect():
        windows.setdefault(r.ts.replace(minute=r.ts.minute // 5 * 5, second=0), []).append(r)
    want = []
    for start, rows in windows.items():
        if start + dt.timedelta(minutes=5) <= closed:
            errors, times = sum(r.status_code >= 400 for r in rows), sorted(r.response_time_ms for r in rows)
            p95 = times[-(-95 * len(times) // 100) - 1]  # nearest rank
            want += [("ERROR_BURST", str(start), float(errors))] * (errors > 5) + [("SLOW_P95", str(start), p95)] * (p95 > 70.0)
    assert sorted((r.alert, r.start, r.value) for r in got.collect()) == sorted(want) and len({w[0] for w in want}) == 2
    batch = {(r.alert, r.start, r.value) for r in mon.alert_windows(log).collect() if r.alert == "ERROR_BURST"}
    assert {w for w in want if w[0] == "ERROR_BURST"} <= batch
