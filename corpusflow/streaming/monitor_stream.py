"""Structured Streaming twins of the monitoring reports.

Sources are file streams over the log tables (any file source works the same
way; tests use the parquet tables).  Event time is cast from
``timestamp_ntz`` to ``timestamp`` because watermarks need the latter.
Late rows older than the watermark are dropped by the windowed aggregates;
the batch report over the stored log stays authoritative.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import ensure_checkpoint_dir
from corpusflow.sources import logs


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of one parquet table in ``sf_dir`` (schema from the batch table)."""
    path = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{path}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def with_event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


def hourly_kpis(requests: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Tumbling hourly counts, errors and mean latency (append mode)."""
    err = (F.col("status_code") >= 400).cast("long")
    return (requests.withWatermark("ts", delay)
            .groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"), F.sum(err).alias("errors"),
                 F.avg("response_time_ms").alias("avg_response_time"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "requests", "errors", "avg_response_time"))


def sliding_kpis(requests: DataFrame, length: str = "60 minutes", slide: str = "10 minutes",
                 delay: str = "1 hour") -> DataFrame:
    """Sliding 60-minute KPIs every 10 minutes.

    p95 (nearest rank) is that of a KLL sketch: exact up to some hundred requests
    a window, within about 1% of ranks beyond, in bounded state.
    """
    err = (F.col("status_code") >= 400).cast("double")
    return (requests.withWatermark("ts", delay)
            .groupBy(F.window("ts", length, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"), (F.avg(err) * 100).alias("error_rate_percent"),
                 F.kll_sketch_agg_double("response_time_ms").alias("sketch"))
            .select(F.col("w.start").alias("window_start"), "requests", "error_rate_percent",
                    F.kll_sketch_get_quantile_double("sketch", F.lit(0.95)).alias("p95")))


def running_perf(predictions: DataFrame) -> DataFrame:
    """Running count and means per model version (complete / update mode)."""
    return predictions.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.avg("preprocessing_time_ms").alias("avg_preprocessing_time"),
        F.avg("prediction_time_ms").alias("avg_prediction_time"),
        F.avg("confidence").alias("avg_confidence"))


def dedup_by_hash(df: DataFrame, key: str = "input_hash", delay: str = "1 hour") -> DataFrame:
    """Drop repeats of the same key within the watermark delay."""
    return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def alert_stream(hourly: DataFrame, error_pct: float = 5.0) -> DataFrame:
    """Hourly windows whose error rate breaks the rule."""
    rate = F.col("errors") * 100.0 / F.col("requests")
    return hourly.filter(rate > error_pct).select("window_start", "requests", "errors",
                                                   rate.alias("error_rate_percent"),
                                                   F.lit("HIGH_ERROR_RATE").alias("alert"))


def run_to_table(df: DataFrame, name: str, mode: str = "append", run: str | None = None) -> DataFrame:
    """Run a stream over everything available into a Parquet table and return it."""
    return foreach_batch_to_table(df, name, lambda batch, epoch: batch, mode=mode, run=run)


def foreach_batch_to_table(df: DataFrame, name: str, handler, mode: str = "append", run: str | None = None) -> DataFrame:
    """Run ``handler(batch_df, epoch_id) -> DataFrame`` per micro-batch into a Parquet table; return that table.

    Table and checkpoint lie under the session's ``spark.checkpoint.dir`` (a
    shared folder on a cluster).  Each epoch has a folder of its own, which a
    replayed epoch overwrites.  A caller that passes the same ``run`` again
    resumes where it stopped.  In ``complete`` mode the table is the last epoch's.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    run = run or uuid.uuid4().hex
    out = f"{base}/tables/{name}-{run}"
    last = {"epoch": None, "schema": None}

    def sink(batch, epoch):
        rows = handler(batch, epoch)
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        last.update(epoch=epoch, schema=rows.schema)

    q = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{base}/streams/{name}-{run}").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if mode == "complete" and last["epoch"] is not None:
        return spark.read.schema(last["schema"]).parquet(f"{out}/epoch={last['epoch']}")
    if last["schema"] is None:  # nothing new: the table is what earlier runs wrote
        return spark.read.option("basePath", out).parquet(out).drop("epoch")
    return spark.read.schema(last["schema"]).option("basePath", out).parquet(out).select(*last["schema"].names)


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(logs.request_log(table_stream(spark, sf_dir, "events")))


def prediction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(logs.prediction_log(table_stream(spark, sf_dir, "events")))
