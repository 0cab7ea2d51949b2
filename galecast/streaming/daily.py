"""Daily statistics kept up to date while scored rows arrive.

The state store holds sums per window of *arrival*, day and region. Arrival only
moves on, so no row is ever behind the watermark, however old the hour it is
about; the watermark only drops the sums of windows that are over from the
state. Every batch emits the sums it changed. They replace what is stored of the
same window, and the sums of earlier windows are folded into one row per day and
region, so neither state nor table grows with the number of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galecast.operators.keys import newest_per_key
from galecast.plans.gold import DAILY_EXPORT, calendar_date
from galecast.sources.tables import read_or_empty, stored, write_table

SUMS = (
    "date date, admin_names string, opened timestamp, _sum double, _known long, _top struct<R_total:double,fcstTime:string>, "
    "_rows long, batch long"
)
WINDOW, DELAY = "1 hour", "10 minutes"


def sums_path(path: str) -> str:
    """Where the sums behind the table at ``path`` are kept, by date."""
    return path.rstrip("/") + "_sums"


def arrival_sums(scored: DataFrame, region: str = "admin_names", window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """A stream of sums per arrival window, date and region; in update mode, those a batch changed."""
    dated = scored.where(F.col(region).isNotNull()).select(
        calendar_date(F.col("fcstDate")).alias("date"), F.col(region).alias("admin_names"),
        F.struct(F.col("R_total").cast("double").alias("R_total"), F.col("fcstTime").cast("string").alias("fcstTime")).alias("top"),
        F.current_timestamp().alias("arrived"),
    ).withWatermark("arrived", delay)
    return dated.groupBy(F.window("arrived", window).alias("at"), "date", "admin_names").agg(
        F.sum("top.R_total").alias("_sum"), F.count("top.R_total").alias("_known"), F.max("top").alias("_top"), F.count("*").alias("_rows")
    )


def _folded(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("_sum").alias("_sum"), F.sum("_known").alias("_known"), F.max("_top").alias("_top"), F.sum("_rows").alias("_rows")
    )


def add_sums(changed: DataFrame, number: int, path: str) -> None:
    """Put the sums that a batch changed into the table and write the days they touch anew; other dates are not read.

    The same batch added twice gives the same table: its window is the newest,
    and only earlier ones are folded.
    """
    spark = changed.sparkSession
    new = stored(changed.select("date", "admin_names", F.col("at.start").alias("opened"), "_sum", "_known", "_top", "_rows", F.lit(number).cast("long").alias("batch")), "sums")
    dates = [r["date"] for r in new.select("date").distinct().collect()]  # one row a day of the batch
    if not dates:
        return
    known = [d for d in dates if d is not None]
    touched = F.col("date").isin(known) if known else F.lit(False)
    if None in dates:
        touched = touched | F.col("date").isNull()
    have = read_or_empty(spark, sums_path(path), SUMS).where(touched)
    rows = newest_per_key(have.unionByName(new), ["date", "admin_names", "opened"], ["batch"])
    open_from = new.agg(F.min("opened")).first()[0]
    over = F.col("opened").isNull() | (F.col("opened") < F.lit(open_from))
    folded = _folded(rows.where(over), "date", "admin_names").withColumns(
        {"opened": F.lit(None).cast("timestamp"), "batch": F.lit(-1).cast("long")}
    )
    merged = stored(rows.where(~over).unionByName(folded), "sums")
    write_table(merged, sums_path(path), ["date"])
    days = _folded(merged, "date", "admin_names").select(
        "date", "admin_names", F.try_divide("_sum", "_known").alias("r_total_avg"), F.col("_top.R_total").alias("r_total_max"),
        F.col("_rows").alias("obs_cnt"), F.col("_top.fcstTime").alias("max_time"),
    )
    write_table(days.select(*DAILY_EXPORT), path, ["date"])


def keep_daily(
    scored: DataFrame, path: str, checkpoint: str, region: str = "admin_names", once: bool = True,
    window: str = WINDOW, delay: str = DELAY,
) -> StreamingQuery:
    """As the batch table, per day of the wall clock, whatever the order in which rows arrive."""
    writer = (
        arrival_sums(scored, region, window, delay).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda changed, number: add_sums(changed, number, path))
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
