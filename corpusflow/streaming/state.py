"""Keyed state over log streams: the newest N predictions, and alerts about what does not arrive.

Both run as ``transformWithState`` on the RocksDB state store, so state grows
with the number of keys and not with the log, and is restored from the
checkpoint after a restart.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE, HOUR = 60_000, 3_600_000


def use_rocksdb(spark: SparkSession) -> None:
    """State processors need this state store; streams without them run on either."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


#: Times are microseconds, so that rows from state and from the batch compare alike.
HELD = "at long, seq long, confidence double, prediction string"
NEWEST = "model_version string, part int, seen long, " + HELD


class NewestRows(StatefulProcessor):
    """Holds a key's ``n`` newest rows by (ts, seq), whatever order they come in; reports the ``window`` newest after each batch."""

    def __init__(self, n: int, window: int):
        self.n, self.window = n, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", HELD)
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new, count = [], self.seen.get()[0] if self.seen.exists() else 0

        def counted():
            nonlocal count
            for r in rows:
                count += 1
                yield r.at, r.seq, r.confidence, r.prediction

        new = heapq.nlargest(self.n, chain(self.held.get(), counted()), key=lambda r: (r[0], r[1]))
        self.held.put([tuple(r) for r in new])
        self.seen.update((count,))
        for at, seq, confidence, prediction in new[:self.window]:
            yield Row(model_version=key[0], part=key[1], seen=count, at=at, seq=seq, confidence=confidence, prediction=prediction)


def newest_predictions(predictions: DataFrame, n: int = 1000, window: int = 100, parts: int = 8) -> DataFrame:
    """Per model version and part, the ``window`` newest of the ``n`` held predictions, and how many were seen (update mode).

    A version's rows are dealt to ``parts`` keys by hash, so one that holds most of
    the log is not one task; the newest of a version are among the newest of its
    parts.
    """
    use_rocksdb(predictions.sparkSession)
    part = F.pmod(F.xxhash64("seq"), F.lit(parts)).cast("int")
    rows = predictions.select("model_version", part.alias("part"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
                              F.col("seq").cast("long").alias("seq"), "confidence", "prediction")
    out = rows.groupBy("model_version", "part").transformWithState(NewestRows(n, window), NEWEST, "Update", "None")
    return out.withColumn("ts", F.timestamp_micros("at")).drop("at")


def latest_window(reports: DataFrame, window: int = 100) -> DataFrame:
    """The ``window`` newest predictions of each version, from the reports of ``newest_predictions``, and ``total``, the rows seen.

    A part's last report is the one that has seen most.  At most parts x window rows per version are ranked.
    """
    last = reports.groupBy("model_version", "part").agg(F.max("seen").alias("seen"))
    total = last.groupBy("model_version").agg(F.sum("seen").alias("total"))
    order = Window.partitionBy("model_version").orderBy(F.desc("ts"), F.desc("seq"))
    newest = reports.join(last, ["model_version", "part", "seen"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= window)
    return newest.join(total, "model_version").select("model_version", "total", "rank", "ts", "seq", "confidence", "prediction")


def drift_by_version(latest: DataFrame, window: int = 100, low_conf: float = 0.7, ratio_alert: float = 0.3, std_alert: float = 0.25) -> DataFrame:
    """The drift report of ``monitor.drift_report``, one row per model version."""
    agg = latest.groupBy("model_version").agg(
        F.max("total").alias("total"), F.avg("confidence").alias("m"), F.stddev_pop("confidence").alias("s"),
        F.avg((F.col("confidence") < low_conf).cast("double")).alias("low"))
    ok = F.col("total") >= window
    alerts = F.filter(F.array(F.when(F.col("low") > ratio_alert, F.lit("HIGH_LOW_CONFIDENCE_RATIO")),
                              F.when(F.col("s") > std_alert, F.lit("HIGH_CONFIDENCE_VARIANCE"))), lambda x: x.isNotNull())
    return agg.select("model_version", F.when(ok, F.lit("analyzed")).otherwise(F.lit("insufficient_data")).alias("status"),
                      F.when(ok, F.lit(window)).alias("window_size"),
                      *[F.when(ok, F.round(c, 6)).alias(a) for c, a in (("m", "confidence_mean"), ("s", "confidence_std"), ("low", "low_confidence_ratio"))],
                      F.when(ok, F.array_join(alerts, ",")).alias("drift_alerts"))


ALERT = "key string, alert string, start_ms long, value double"


class QuietWatch(StatefulProcessor):
    """Per key: minutes that end a run without requests, and long absence, told by event-time timers.

    State: the last minute with requests, the time of its last request, the last
    minute that was settled (told or covered), and whether absence was told.
    """

    def __init__(self, quiet_minutes: int, absent_hours: float):
        self.quiet, self.absent_ms = quiet_minutes, int(absent_hours * HOUR)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "minute long, at long, settled long, absent boolean")

    def next_quiet(self, minute: int, settled: int) -> int:
        return max(minute + self.quiet, settled + 1)

    def quiet_rows(self, key, minutes) -> Iterator[Row]:
        for m in minutes:
            yield Row(key=key[0], alert="LOW_TRAFFIC", start_ms=m * MINUTE, value=float(self.quiet))

    def wake(self, minute: int, at: int, settled: int, absent: bool) -> None:
        """Timers for the end of the next quiet minute, and for absence."""
        self.handle.registerTimer((self.next_quiet(minute, settled) + 1) * MINUTE)
        if not absent:
            self.handle.registerTimer(at + self.absent_ms + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.state.get() if self.state.exists() else None
        for minute, at in sorted((r.minute, r.at) for r in rows):
            if state is not None:
                last, _, settled, _ = state
                if minute <= last:
                    continue
                yield from self.quiet_rows(key, range(self.next_quiet(last, settled), minute))
            state = (minute, at, minute, False)
        if state is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.state.update(tuple(state))
            self.wake(*state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        minute, at, settled, absent = self.state.get()
        closed = now // MINUTE - 1  # the last minute that ended before the watermark
        yield from self.quiet_rows(key, range(self.next_quiet(minute, settled), closed + 1))
        settled = max(settled, closed)
        if not absent and now > at + self.absent_ms:
            absent = True
            yield Row(key=key[0], alert="ABSENT", start_ms=at, value=(now - at) / HOUR)
        self.state.update((minute, at, settled, absent))
        self.wake(minute, at, settled, absent)


def quiet_alerts(requests: DataFrame, key: Column | None = None, quiet_minutes: int = 10, absent_hours: float = 23.0, delay: str = "1 hour") -> DataFrame:
    """``LOW_TRAFFIC`` and ``ABSENT`` of ``monitor.alert_windows``, per ``key``, as soon as the watermark has closed a minute (append mode).

    Requests are first counted per key and minute, with partial sums in every
    task, so a busy key reaches its state as one row a minute.
    """
    use_rocksdb(requests.sparkSession)
    minutes = (requests.withColumn("key", F.lit("all") if key is None else key).withWatermark("ts", delay)
               .groupBy("key", F.window("ts", "1 minute").alias("w")).agg(F.max("ts").alias("last")))
    rows = minutes.select("key", "w", (F.unix_seconds("w.start") / 60).cast("long").alias("minute"), F.unix_millis("last").alias("at"))
    out = rows.groupBy("key").transformWithState(QuietWatch(quiet_minutes, absent_hours), ALERT, "Append", "EventTime")
    return out.select("key", "alert", F.timestamp_millis("start_ms").alias("start"), "value")


def burst_alerts(requests: DataFrame, error_count: int = 5, p95_ms: float = 5000.0, delay: str = "1 hour") -> DataFrame:
    """``ERROR_BURST`` and ``SLOW_P95`` over 5-minute windows, when the watermark has closed them (append mode).

    The 95th percentile (nearest rank) comes from a KLL sketch per window: exact
    up to some hundred requests, within about 1% of ranks beyond, in bounded state.
    """
    err = F.count_if(F.col("status_code") >= 400).cast("double")
    w = (requests.withWatermark("ts", delay).groupBy(F.window("ts", "5 minutes").alias("w"))
         .agg(err.alias("errors"), F.kll_sketch_agg_double("response_time_ms").alias("sketch")))
    p95 = F.kll_sketch_get_quantile_double("sketch", F.lit(0.95))
    both = F.array(F.when(F.col("errors") > error_count, F.struct(F.lit("ERROR_BURST").alias("alert"), F.col("errors").alias("value"))),
                   F.when(p95 > p95_ms, F.struct(F.lit("SLOW_P95").alias("alert"), p95.alias("value"))))
    return w.select(F.col("w.start").alias("start"), F.explode(F.filter(both, lambda x: x.isNotNull())).alias("a")).select("a.alert", "start", "a.value")
