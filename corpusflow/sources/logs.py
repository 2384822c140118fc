"""Request and prediction logs.

The library works on log *tables*: every monitoring operator reads a request
log ``(ts, endpoint, method, status_code, response_time_ms, ...)`` or a
prediction log ``(ts, seq, model_version, prediction, confidence, ...)``.  Logs
arrive as JSON lines (``parse_request_log`` / ``parse_prediction_log``) or as
views derived from the ``events`` table (``request_log`` / ``prediction_log``),
which is how the tests and benchmark drive them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The endpoints and error statuses the events-derived request log uses.
ENDPOINTS = ["/predict", "/health", "/monitoring/metrics", "/"]
ERROR_STATUSES = [500, 404, 503]

REQUEST_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("response_time_ms", T.DoubleType()),
    T.StructField("request_size_bytes", T.LongType()),
    T.StructField("response_size_bytes", T.LongType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("ip_address", T.StringType()),
])

TOP_PREDICTION = T.StructType([
    T.StructField("class", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("input_text", T.StringType()),
    T.StructField("input_hash", T.StringType()),
    T.StructField("input_length", T.LongType()),
    T.StructField("prediction", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("top_predictions", T.ArrayType(TOP_PREDICTION)),
    T.StructField("preprocessing_time_ms", T.DoubleType()),
    T.StructField("prediction_time_ms", T.DoubleType()),
    T.StructField("total_time_ms", T.DoubleType()),
    T.StructField("feature_stats", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_loaded_at", T.StringType()),
    T.StructField("feature_engine_version", T.StringType()),
    T.StructField("memory_usage_mb", T.DoubleType()),
    T.StructField("cpu_usage_percent", T.DoubleType()),
])

ERROR_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("input_hash", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("total_errors", T.LongType()),
])


def event_key(events: DataFrame) -> F.Column:
    """The integer ``k`` carried in ``events.props`` (JSON ``{"k": n}``)."""
    return F.get_json_object("props", "$.k").cast("int")


def request_log(events: DataFrame) -> DataFrame:
    """Request log derived from ``events`` (one request per event)."""
    k = event_key(events)
    endpoint = F.element_at(F.array(*[F.lit(e) for e in ENDPOINTS]), (k % 4 + 1).cast("int"))
    status = F.when(F.col("event_type") == "error",
                    F.element_at(F.array(*[F.lit(s) for s in ERROR_STATUSES]),
                                 (F.col("event_id") % 3 + 1).cast("int"))).otherwise(F.lit(200))
    return events.select(
        F.col("event_id"),
        F.col("ts"),
        endpoint.alias("endpoint"),
        F.when(endpoint == "/predict", F.lit("POST")).otherwise(F.lit("GET")).alias("method"),
        status.cast("int").alias("status_code"),
        F.col("value").alias("response_time_ms"),
        F.col("user_id").cast("string").alias("user_agent"),
    )


def prediction_log(events: DataFrame, model_version: str = "v1") -> DataFrame:
    """Prediction log derived from ``events`` (one prediction per event)."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts"),
        F.lit(model_version).alias("model_version"),
        F.col("event_type").alias("prediction"),
        (F.lit(1.0) / (F.lit(1.0) + F.col("value") / F.lit(100.0))).alias("confidence"),
        (F.lit(0.3) * F.col("value")).alias("preprocessing_time_ms"),
        (F.lit(0.7) * F.col("value")).alias("prediction_time_ms"),
        F.col("value").alias("total_time_ms"),
    )


def parse_json_log(lines: DataFrame, schema: T.StructType, column: str = "value",
                   envelope: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parse JSON lines into (good rows, rejected lines).

    ``envelope=True`` reads the structured-log shape ``{level, logger,
    timestamp, message: {...}}`` and takes the record from ``message``.
    Lines that do not parse (or parse to all-null) go to the reject output
    with their raw text, so nothing is silently dropped.
    """
    if envelope:
        env = T.StructType([
            T.StructField("level", T.StringType()),
            T.StructField("logger", T.StringType()),
            T.StructField("timestamp", T.StringType()),
            T.StructField("message", schema),
        ])
        parsed = lines.select(F.col(column).alias("_raw"),
                              F.from_json(F.col(column), env).alias("_env"))
        parsed = parsed.select("_raw", F.col("_env.message").alias("_rec"))
    else:
        parsed = lines.select(F.col(column).alias("_raw"),
                              F.from_json(F.col(column), schema).alias("_rec"))
    ok = F.col("_rec").isNotNull() & F.coalesce(
        *[F.col(f"_rec.{f.name}").isNotNull() for f in schema.fields[:1]])
    good = parsed.filter(ok).select("_rec.*")
    bad = parsed.filter(~ok | F.col("_rec").isNull()).select(F.col("_raw").alias("raw"))
    return good, bad


def with_event_time(df: DataFrame, column: str = "timestamp", out: str = "ts") -> DataFrame:
    """ISO-8601 UTC strings (``...Z`` or ``+00:00``) to a timestamp column."""
    return df.withColumn(out, F.to_timestamp(F.regexp_replace(F.col(column), "Z$", "+00:00")))
