"""Hourly sketch tables of a request log, merged for any window of hours.

One row per hour and endpoint holds counts, sums and two mergeable sketches:
distinct clients (HLL) and latencies (KLL).  A report over any run of hours
merges rows of this table and reads no request again.  Sketches are built with
partial aggregation, so a busy endpoint is summed in every task first.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Standard errors at these sizes: about 1.6% of distinct counts and 1.3% of ranks.
LG_K, KLL_K = 12, 200


def hourly_sketches(requests: DataFrame, client_col: str = "user_agent") -> DataFrame:
    """(hour, endpoint, requests, errors, time_sum, clients, latencies); null latencies are left out of the sketch."""
    return requests.groupBy(F.date_trunc("hour", "ts").alias("hour"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_code") >= 400).alias("errors"), F.sum("response_time_ms").alias("time_sum"),
        F.hll_sketch_agg(client_col, LG_K).alias("clients"), F.kll_sketch_agg_double("response_time_ms", F.lit(KLL_K)).alias("latencies"))


def merged(sketches: DataFrame, start=None, end=None, by: tuple[str, ...] = ("endpoint",), shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Requests, errors, mean latency, distinct clients and latency percentiles of the hours in [``start``, ``end``), per ``by``."""
    hours = sketches
    if start is not None:
        hours = hours.filter(F.col("hour") >= F.lit(start).cast(sketches.schema["hour"].dataType))
    if end is not None:
        hours = hours.filter(F.col("hour") < F.lit(end).cast(sketches.schema["hour"].dataType))
    one = hours.groupBy(*by).agg(F.sum("requests").alias("requests"), F.sum("errors").alias("errors"), F.sum("time_sum").alias("time_sum"),
                                 F.hll_union_agg("clients").alias("clients"), F.kll_merge_agg_double("latencies").alias("latencies"))
    n = F.kll_sketch_get_n_double("latencies")
    return one.select(*by, "requests", "errors", F.when(n > 0, F.col("time_sum") / n).alias("avg_response_time_ms"),
                      F.hll_sketch_estimate("clients").alias("clients"),
                      *[F.when(n > 0, F.kll_sketch_get_quantile_double("latencies", F.lit(p))).alias(f"p{p * 100:g}") for p in shares])
