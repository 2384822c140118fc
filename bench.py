"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line with per-query seconds.  A query is
executed to completion with the ``noop`` sink (no driver collection).  Each
query is timed cold (first run in the session, fresh caches) and the reported
value is that first run; ``warm_median`` holds the median of two more runs.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "class_top_terms", "clean_pipeline", "text_quality", "null_profile", "iqr_outliers",
    "vocabulary", "tfidf", "f_score", "nb_predict", "classification_report",
    "rolling_kpis", "endpoint_metrics", "hourly_trends", "drift_report", "dashboard_series",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    from corpusflow.session import get_spark
    from corpusflow.plans.queries import QUERIES
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), conf={
        "spark.driver.memory": "16g", "spark.corpusflow.minTextSplits": str(2 * cpus)})
    first, warm = {}, {}
    for name in names:
        spark.catalog.clearCache()
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        first[name] = round(time.time() - t0, 3)
        runs = []
        for _ in range(repeats):
            t0 = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        warm[name] = round(statistics.median(runs), 3) if runs else None
    total = round(sum(first.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_first_run", "value": total, "unit": "sec",
        "queries": first, "warm_median": warm, "sf": sf, "cpus": cpus,
        "spark": spark.version, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))


if __name__ == "__main__":
    main()
