"""Seconds of the headline queries on the tables in BENCH_SF_DIR; prints one JSON line.

Every query runs once to warm up (class loading, code generation, file cache)
and is then timed BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from checks.spark_queries import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "raw_items_explode", "canonicalize", "short_fcst_wide", "nowcast_wide", "dedupe_keys",
    "coalesce_join", "silver_merge", "attach_regions", "percentile_minmax", "rain_risk",
    "heat_risk", "typhoon_risk", "score_all", "interp_series", "track_hourly",
    "storm_distance", "uv_hourly", "silver_build", "gold_latest", "gold_daily",
)


def run(query, spark: SparkSession) -> float:
    started = time.perf_counter()
    result: DataFrame = query(spark, SF_DIR)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds = {}
    for name in HEADLINE:
        run(known[name], spark)
        seconds[name] = round(statistics.median(run(known[name], spark) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
