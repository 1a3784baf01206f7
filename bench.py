"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1) and ``BENCH_CPUS`` the threads.
Each query runs once cold and then three times; the median of the three counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import QUERIES
from eventloom.session import build_session

HEADLINE = [
    "normalize_batch", "json_scan", "stg_raw_events", "stg_push", "stg_pr", "fact_events",
    "daily_repo", "actor_activity", "repo_profile", "repo_push_stats", "repo_descriptions",
    "dim_actor", "latest_repo", "trending_repos", "active_contributors", "language_popularity",
    "scd2", "insert_if_absent", "incremental_daily", "dq_not_null", "dq_unique", "dq_relationships",
    "anomaly_trend", "anomaly_zscore", "anomaly_piecewise", "customer_rank", "part_top_k",
    "stream_daily",
]


def run(fn, spark, sf_dir) -> float:
    started = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, cold = {}, {}
    for name in names:
        cold[name] = round(run(QUERIES[name], spark, sf_dir), 3)
        times[name] = round(statistics.median(run(QUERIES[name], spark, sf_dir) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "cold": cold, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "spark": spark.version, "cpus": int(cpus), "shuffle_partitions": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
