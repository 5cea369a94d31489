"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Each query
runs once to warm up and then three times into a no-op sink; the best time
counts. Streaming jobs run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from adtrail.plans.queries import QUERIES

BATCH = [
    "attribution_user",
    "attribution_busy_users",
    "attribution_interval",
    "attribution_busy_interval",
    "left_join_user",
    "dedup_keys",
    "dedup_first",
    "ingest_impressions",
    "ingest_clicks",
    "ingest_bids",
    "valid_rows",
    "invalid_rows",
    "quality_metrics",
    "decode_json",
    "json_round_trip",
]
STREAMS = [
    "table_append_read",
    "stream_late_rows",
    "stream_dedup",
    "stream_fan_out",
    "stream_attribution",
    "stream_quality_metrics",
    "read_back",
    "attribution_in_periods",
]
RUNS = 3


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    drain(QUERIES[name](spark, sf_dir))
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in BATCH:
        timed(spark, name, sf_dir)
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    for name in STREAMS:
        seconds[name] = round(timed(spark, name, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
