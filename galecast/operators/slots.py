"""Target hours: which hours of a feed are wanted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.functions.clock import (
    ISSUE_BUFFER_MINUTES,
    YEAR_RANGE,
    floor_hour,
    forecast_clock,
    hour_steps,
    issue_time,
    plus_hours,
    time_text,
)

HORIZON_HOURS = 6
SLOT = ("fcstDate", "fcstTime")
CELL = ("nx", "ny")


def slot_columns(clock: Column) -> dict[str, Column]:
    return {
        "fcstDate": F.date_format(clock, "yyyyMMdd"),
        "fcstTime": F.date_format(clock, "HHmm"),
    }


def poll_bases(polls: DataFrame, now: str = "now", buffer_minutes: int = ISSUE_BUFFER_MINUTES) -> DataFrame:
    """Add to each poll time the issue to ask for: ``base_ts``, ``baseDate``, ``baseTime``."""
    issued = polls.withColumn("base_ts", issue_time(F.col(now), buffer_minutes=buffer_minutes))
    return issued.withColumns(
        {
            "baseDate": F.date_format("base_ts", "yyyyMMdd"),
            "baseTime": F.date_format("base_ts", "HHmm"),
        }
    )


def target_slots(
    bases: DataFrame, horizon: int = HORIZON_HOURS, now: str | None = "now", base: str = "base_ts"
) -> DataFrame:
    """``horizon`` hourly slots per row, from one hour after the base.

    With ``now`` they start no earlier than the current hour, so that they line
    up with the other feeds.
    """
    start = plus_hours(F.col(base), 1)
    if now is not None:
        start = F.greatest(start, floor_hour(F.col(now)))
    hours = hour_steps(start, plus_hours(start, horizon - 1))
    exploded = bases.withColumn("slot_ts", F.explode(hours))
    return exploded.withColumns(slot_columns(F.col("slot_ts")))


def keep_slots(items: DataFrame, slots: DataFrame) -> DataFrame:
    """Only the items in the given slots, each once.

    The slots are the ``horizon`` hours of one poll; Spark broadcasts them by size.
    """
    return items.join(slots.select(*SLOT).distinct(), list(SLOT), "left_semi").select(*items.columns)


def keep_slots_or_fallback(
    items: DataFrame, slots: DataFrame, fallback: DataFrame, cell: Sequence[str] = CELL
) -> DataFrame:
    """As ``keep_slots``; cells without any item there use the fallback slots."""
    hits = keep_slots(items, slots)
    served = hits.select(*cell).distinct()
    rest = keep_slots(items, fallback).join(served, list(cell), "left_anti").select(*items.columns)
    return hits.unionByName(rest)


def keep_hours_or_fallback(
    items: DataFrame, start: Column, fallback: Column, horizon: int = HORIZON_HOURS, cell: Sequence[str] = CELL
) -> DataFrame:
    """As ``keep_slots_or_fallback``, for slots that follow from columns of the row: the ``horizon`` full hours from ``start``.

    Any number of polls is served by one plan; ``cell`` then holds the poll.
    """
    at = forecast_clock(F.col("fcstDate"), time_text(F.col("fcstTime")))

    def within(first: Column) -> Column:
        return at.between(first, plus_hours(first, horizon - 1)) & (F.minute(at) == 0)

    hits = items.where(within(start))
    served = hits.select(*cell).distinct()
    rest = items.where(within(fallback)).join(served, list(cell), "left_anti").select(*items.columns)
    return hits.unionByName(rest)


def forecast_hours(feed: DataFrame) -> DataFrame:
    """The distinct valid times of one feed, as ``ts``; unreadable ones drop out."""
    if set(SLOT) <= set(feed.columns):
        ts = forecast_clock(F.col("fcstDate").cast("string"), time_text(F.col("fcstTime")))
    elif "time" in feed.columns:
        ts = F.col("time").try_cast("timestamp_ntz")
    else:
        return feed.limit(0).select(F.lit(None).cast("timestamp_ntz").alias("ts"))
    hours = feed.select(ts.alias("ts")).where(F.year("ts").between(*YEAR_RANGE))
    return hours.distinct()


def all_forecast_hours(feeds: Sequence[DataFrame]) -> DataFrame:
    """The distinct valid times of several feeds together."""
    hours = forecast_hours(feeds[0])
    for feed in feeds[1:]:
        hours = hours.unionByName(forecast_hours(feed))
    return hours.distinct()


def newest_hours(hours: DataFrame, horizon: int = HORIZON_HOURS, now: Column | None = None) -> DataFrame:
    """The newest ``horizon`` times cut to the hour, repeats removed.

    Without any time the result is the hour of ``now``, when given.
    """
    newest = hours.select("ts").distinct().orderBy(F.desc("ts")).limit(max(1, horizon))
    floored = newest.select(floor_hour(F.col("ts")).alias("ts")).distinct()
    if now is None:
        return floored
    return _or_else(floored, [floor_hour(now)])


def last_hours(hours: DataFrame, now: Column, window: int = HORIZON_HOURS) -> DataFrame:
    """Exactly ``window`` hourly times, ending at the newest given hour, else at ``now``."""
    end = F.coalesce(F.max(floor_hour(F.col("ts"))), floor_hour(now))
    return hours.agg(end.alias("end")).select(
        F.explode(hour_steps(plus_hours(F.col("end"), 1 - window), F.col("end"))).alias("ts")
    )


def hours_or_last(hours: DataFrame, now: Column, window: int = HORIZON_HOURS) -> DataFrame:
    """All given times, to the minute; without any, the ``window`` hours up to ``now``.

    They go on as one value: a year of hours is under 0.5 MB, and of feeds that
    give minutes it is at most sixty times that.
    """
    return _or_else(hours, [plus_hours(floor_hour(now), -i) for i in range(window)])


def _or_else(hours: DataFrame, otherwise: Sequence[Column]) -> DataFrame:
    """The distinct times, or the given ones when there are none; a few dozen rows."""
    found = F.array_sort(F.collect_set("ts"))
    chosen = F.when(F.size(found) > 0, found).otherwise(F.array(*otherwise))
    return hours.agg(chosen.alias("all")).select(F.explode("all").alias("ts"))
