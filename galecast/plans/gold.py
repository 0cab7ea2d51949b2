"""Scored rows to the published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from galecast.functions.clock import forecast_clock
from galecast.functions.scores import risk_level
from galecast.sources.tables import RUN_COLUMN, read_or_empty, read_table, run_inventory, stored, write_table

LATEST_COLUMNS = (
    "admin_names", "fcst_ts", "dt", "R_total",
    "R_rain", "R_heat", "R_wind", "R_uv", "R_typhoon", "risk_level",
)
LATEST_EXPORT = ("admin_names", "fcst_ts", "R_total", "risk_level")
DAILY_EXPORT = ("date", "admin_names", "r_total_avg", "r_total_max", "max_time", "obs_cnt")


def newest_per_region(silver: DataFrame, region: str = "admin_names") -> DataFrame:
    """The newest scored row of each region, with all its columns and its level.

    Ties go to the later run, then the higher total, then the smaller cell.
    Spark keeps one row per region and task before the shuffle.
    """
    if "fcst_ts" not in silver.columns:
        silver = silver.withColumn("fcst_ts", forecast_clock(F.col("fcstDate"), F.col("fcstTime")))
    newest_first = Window.partitionBy(region).orderBy(
        F.desc_nulls_last("fcst_ts"), F.desc_nulls_last("dt"), F.desc_nulls_last("R_total"), "nx", "ny"
    )
    ranked = silver.where(F.col(region).isNotNull()).withColumn("_rank", F.row_number().over(newest_first))
    newest = ranked.where(F.col("_rank") == 1).drop("_rank")
    return newest.withColumn("risk_level", risk_level(F.col("R_total")))


def latest(silver: DataFrame, region: str = "admin_names") -> DataFrame:
    columns = [c if c != "admin_names" else region for c in LATEST_COLUMNS]
    return newest_per_region(silver, region).select(*columns)


def calendar_date(text: Column) -> Column:
    return F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")


def hourly(silver: DataFrame, region: str = "admin_names") -> DataFrame:
    """Sum, counts and maximum per date, region and time, in fixed-width hash aggregation over all rows."""
    dated = silver.where(F.col(region).isNotNull()).select(
        calendar_date(F.col("fcstDate")).alias("date"), region, "fcstTime", "R_total"
    )
    return dated.groupBy("date", region, "fcstTime").agg(
        F.sum("R_total").alias("_sum"),
        F.count("R_total").alias("_known"),
        F.max("R_total").alias("_max"),
        F.count("*").alias("_rows"),
    )


def daily_of_hours(hours: DataFrame, region: str = "admin_names") -> DataFrame:
    return hours.groupBy("date", region).agg(
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("r_total_avg"),
        F.max("_max").alias("r_total_max"),
        F.sum("_rows").alias("obs_cnt"),
        F.max(F.struct("_max", "fcstTime"))["fcstTime"].alias("max_time"),
    )


def daily(silver: DataFrame, region: str = "admin_names") -> DataFrame:
    """Mean, maximum, count and time of the maximum per date and region.

    First by hour, over all rows; then over the at most one row per hour that
    is left. Of equal maxima the later time counts.
    """
    return daily_of_hours(hourly(silver, region), region)


def export_latest(gold_latest: DataFrame) -> DataFrame:
    return gold_latest.select(*LATEST_EXPORT)


def export_daily(gold_daily: DataFrame) -> DataFrame:
    return gold_daily.select(*DAILY_EXPORT)


def run_latest(spark: SparkSession, silver: str, gold: str, table_format: str = "parquet") -> None:
    rows = read_table(spark, silver, table_format)
    write_table(latest(rows), gold, table_format=table_format)


def run_daily(
    spark: SparkSession, silver: str, gold: str, table_format: str = "parquet",
    dates: tuple[str, str] | None = None,
) -> None:
    """All dates, or only those from and to ``yyyyMMdd``; other dates stay as they are."""
    rows = read_table(spark, silver, table_format)
    if dates:
        rows = rows.where(F.col("fcstDate").between(*dates))
    write_table(daily(rows), gold, ["date"], table_format=table_format)


PARTIALS = (
    "date date, admin_names string, _sum double, _known long, _top struct<R_total:double,fcstTime:string>, _rows long, stamp long, dt string"
)


def daily_partials(silver: DataFrame, region: str = "admin_names") -> DataFrame:
    """Sums per run, date and region, which add up to the daily table."""
    dated = silver.where(F.col(region).isNotNull()).select(
        RUN_COLUMN, calendar_date(F.col("fcstDate")).alias("date"), F.col(region).alias("admin_names"),
        F.struct(F.col("R_total"), F.col("fcstTime").cast("string").alias("fcstTime")).alias("top"),
    )
    return dated.groupBy(RUN_COLUMN, "date", "admin_names").agg(
        F.sum("top.R_total").alias("_sum"), F.count("top.R_total").alias("_known"), F.max("top").alias("_top"), F.count("*").alias("_rows")
    )


def daily_of_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy("date", "admin_names").agg(
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("r_total_avg"), F.max("_top.R_total").alias("r_total_max"),
        F.sum("_rows").alias("obs_cnt"), F.max("_top")["fcstTime"].alias("max_time"),
    )


def run_daily_incremental(spark: SparkSession, silver: str, gold: str, partials: str) -> list[str]:
    """Bring the daily table up to date; returns the runs that were read.

    Those are the runs that were never summed up, or were written again since.
    Their sums replace the earlier ones, and only dates that they touch, or
    touched before, are folded and written anew. A date of which no row is left
    stays until it is removed.
    """
    built = read_or_empty(spark, partials, PARTIALS)
    done = built.groupBy(RUN_COLUMN).agg(F.max("stamp").alias("stamp"))
    due = stored(run_inventory(spark, silver).join(done, [RUN_COLUMN, "stamp"], "left_anti"), "due")
    runs = [r[0] for r in due.select(RUN_COLUMN).orderBy(RUN_COLUMN).collect()]  # a row a run
    if not runs:
        return []
    rows = read_table(spark, silver).where(F.col(RUN_COLUMN).isin(*runs))
    fresh = stored(daily_partials(rows).join(due, RUN_COLUMN), "partials")
    dates = stored(built.where(F.col(RUN_COLUMN).isin(*runs)).select("date").union(fresh.select("date")).distinct(), "dates")
    write_table(fresh, partials, [RUN_COLUMN])
    everything = spark.read.schema(PARTIALS).parquet(partials)
    touched = everything.join(dates.withColumnRenamed("date", "_date"), F.col("date").eqNullSafe(F.col("_date")), "left_semi")
    write_table(daily_of_partials(touched), gold, ["date"])
    return runs


def run_latest_observed(
    spark: SparkSession, silver: str, gold: str, threshold: float = 0.6, table_format: str = "parquet"
) -> dict[str, int]:
    """As ``run_latest``; returns the run summary, counted while the table is written."""
    watched = Observation("run_summary")
    rows = latest(read_table(spark, silver, table_format)).observe(
        watched, F.count_if(F.col("R_total") >= threshold).alias("high_risk"), F.count(F.lit(1)).alias("total")
    )
    write_table(rows, gold, table_format=table_format)
    return watched.get


def run_export(
    spark: SparkSession, gold_latest: str, gold_daily: str, out_latest: str, out_daily: str,
    table_format: str = "parquet",
) -> None:
    """Narrow Parquet copies of both tables, replaced as a whole."""
    write_table(export_latest(read_table(spark, gold_latest, table_format)), out_latest)
    rows = export_daily(read_table(spark, gold_daily, table_format))
    rows.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(out_daily)
