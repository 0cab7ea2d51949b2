"""The jobs from the command line: python -m galecast <job> ...

Run hours are yyyyMMddHH. Several run hours build all of them in one plan.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from galecast.functions.clock import now_clock, run_hour
from galecast.operators.regions import clean_calls
from galecast.plans import alerts, bronze, dimensions, features, gold, session, silver
from galecast.sources.schemas import GRID, REGIONS
from galecast.sources.tables import read_dimension, read_table, runs_to_build


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="galecast")
    parser.add_argument("--table_format", default="parquet", help="format of silver and gold, such as delta")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("dimensions", help="region points to regions, call list and grid")
    job.add_argument("--points", required=True)
    job.add_argument("--regions", required=True)
    job.add_argument("--calls", required=True)
    job.add_argument("--grid", required=True)

    job = jobs.add_parser("collect", help="landed responses of all services to bronze feeds, as far as they have arrived")
    job.add_argument("--landed", required=True, help="folder of service=<s>/dt=<run>/... files")
    job.add_argument("--bronze", required=True)
    job.add_argument("--calls", required=True)
    job.add_argument("--grid", help="without it the storm feed is empty")
    job.add_argument("--progress", required=True, help="checkpoint folder of the stream")

    job = jobs.add_parser("silver", help="feeds of one run hour or several to scored rows")
    job.add_argument("--bronze", required=True)
    job.add_argument("--silver_out", required=True)
    job.add_argument("--admin_map", required=True)
    job.add_argument("--run_dt", nargs="*", default=[], help="default: the current hour")
    job.add_argument("--due", action="store_true", help="the runs that landed and are not built, or landed again since")
    job.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])

    job = jobs.add_parser("latest", help="newest row per region")
    job.add_argument("--silver", required=True)
    job.add_argument("--gold", required=True)

    job = jobs.add_parser("daily", help="daily statistics per region")
    job.add_argument("--silver", required=True)
    job.add_argument("--gold", required=True)
    job.add_argument("--dates", nargs=2, metavar=("FROM", "TO"), help="yyyyMMdd; default: all dates")
    job.add_argument("--partials", help="folder of sums by run: only runs that are new or written again are read")

    job = jobs.add_parser("export", help="narrow Parquet copies of both gold tables")
    job.add_argument("--latest", required=True)
    job.add_argument("--daily", required=True)
    job.add_argument("--out_latest", required=True)
    job.add_argument("--out_daily", required=True)

    job = jobs.add_parser("alert", help="message lines of high-risk regions, as text files")
    job.add_argument("--latest", required=True)
    job.add_argument("--out", required=True)

    job = jobs.add_parser("features", help="newest rows as newline-delimited GeoJSON")
    job.add_argument("--silver", required=True)
    job.add_argument("--admin_map", required=True)
    job.add_argument("--out", required=True)
    return parser


def current_run(spark: SparkSession) -> str:
    return spark.range(1).select(run_hour(now_clock()).alias("dt")).first()["dt"]


def main(argv: list[str] | None = None) -> None:
    a = arguments().parse_args(argv)
    spark = session.session(f"galecast-{a.job}")
    fmt = a.table_format
    if a.job == "dimensions":
        dimensions.run_dimensions(read_dimension(spark, a.points, REGIONS), a.regions, a.calls, a.grid)
    elif a.job == "collect":
        calls = clean_calls(read_dimension(spark, a.calls))
        grid = read_dimension(spark, a.grid, GRID) if a.grid else None
        responses = bronze.landed_responses(spark, a.landed)
        bronze.collect(responses, a.bronze, a.progress, calls, grid).awaitTermination()
    elif a.job == "silver":
        runs = runs_to_build(spark, a.bronze, a.silver_out) if a.due else a.run_dt or [current_run(spark)]
        if not runs:
            return
        silver.run_silver(
            spark, a.bronze, a.silver_out, read_dimension(spark, a.admin_map),
            runs[0] if len(runs) == 1 else runs, a.mode, fmt,
        )
    elif a.job == "latest":
        counts = gold.run_latest_observed(spark, a.silver, a.gold, table_format=fmt)
        print(f"regions: {counts['total']}, of high risk: {counts['high_risk']}")
    elif a.job == "daily" and a.partials:
        runs = gold.run_daily_incremental(spark, a.silver, a.gold, a.partials)
        print(f"runs read: {', '.join(runs) or 'none'}")
    elif a.job == "daily":
        gold.run_daily(spark, a.silver, a.gold, fmt, tuple(a.dates) if a.dates else None)
    elif a.job == "export":
        gold.run_export(spark, a.latest, a.daily, a.out_latest, a.out_daily, fmt)
    elif a.job == "alert":
        lines = alerts.alert_lines(read_table(spark, a.latest, fmt))
        lines.orderBy("part", F.desc("line")).select("line").write.mode("overwrite").text(a.out)
    elif a.job == "features":
        newest = gold.newest_per_region(read_table(spark, a.silver, fmt))
        points = read_dimension(spark, a.admin_map, REGIONS)
        features.write_features(features.geojson_features(newest, points), a.out)


if __name__ == "__main__":
    main()
