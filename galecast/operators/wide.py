"""Long feed items to one wide row per cell and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.functions.clock import forecast_clock, time_text, zoned_instant
from galecast.functions.numeric import number_from_text
from galecast.functions.precip import mm_collector
from galecast.operators.coalesce import KEYS
from galecast.operators.keys import first_per_key

# Categories of the feeds.
SHORT_CATEGORIES = ("POP", "PCP", "PTY", "TMP", "REH", "WSD", "SKY")
NOWCAST_CATEGORIES = ("T1H", "RN1", "UUU", "VVV", "REH", "PTY", "VEC", "WSD")
ULTRA_CATEGORIES = ("T1H", "RN1", "SKY", "UUU", "VVV", "REH", "PTY", "LGT", "VEC", "WSD")
CODE_CATEGORIES = ("PTY", "SKY")
BASE_KEYS = ("baseDate", "baseTime")


def pivot_mean(items: DataFrame, keys: Sequence[str], categories: Sequence[str], value: str) -> DataFrame:
    """Mean of each category. Rows without a value or a key do not count, and a key
    without any value does not appear."""
    known = F.col(value).isNotNull() & F.col("category").isin(*categories)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return items.where(known).groupBy(*keys).agg(
        *[F.avg(F.when(F.col("category") == c, F.col(value))).alias(c) for c in categories]
    )


def pivot_last(
    items: DataFrame, keys: Sequence[str], categories: Sequence[str], value: str, order: str
) -> DataFrame:
    """Last non-null value of each category by ``order``, under the same rules."""
    known = F.col(value).isNotNull() & F.col("category").isin(*categories)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return items.where(known).groupBy(*keys).agg(
        *[
            F.max_by(F.col(value), F.when(F.col("category") == c, F.col(order))).alias(c)
            for c in categories
        ]
    )


def short_forecast_wide(
    items: DataFrame, categories: Sequence[str] = SHORT_CATEGORIES, by: Sequence[str] = ()
) -> DataFrame:
    """Short-range items to wide rows: amounts read from text, code columns as whole numbers.

    Categories outside the standard list are ignored, whatever is asked for.
    ``by`` names further key columns, such as the run.
    """
    wanted = [c for c in SHORT_CATEGORIES if c in categories]
    read = F.when(F.col("category") == "PCP", mm_collector(F.col("fcstValue"))).otherwise(
        number_from_text(F.col("fcstValue"))
    )
    wide = pivot_mean(items.withColumn("value", read), [*KEYS, *by], wanted, "value")
    instant = zoned_instant(forecast_clock(F.col("fcstDate"), F.col("fcstTime")))
    return wide.select(
        *KEYS, *by,
        instant.alias("valid_ts_kst"),
        *[
            (F.floor(c).cast("int") if c in CODE_CATEGORIES else F.col(c)).alias(c)
            for c in sorted(wanted)
        ],
    )


def with_region_code(wide: DataFrame, calls: DataFrame) -> DataFrame:
    """Put the region code of each cell's call in front of the short-range rows."""
    codes = calls.select(
        F.col("nx"), F.col("ny"), F.col("admin_code").try_cast("long").alias("admin_code")
    )
    coded = wide.join(codes, ["nx", "ny"], "left")
    return coded.select("admin_code", *wide.columns)


def unique_short_forecast(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per region code, cell and hour."""
    keys = [*by, *[c for c in ("admin_code", *KEYS) if c in wide.columns]]
    return first_per_key(wide, keys)


def latest_wide(
    items: DataFrame, categories: Sequence[str], order: str = "seq", by: Sequence[str] = ()
) -> DataFrame:
    """Nowcast or ultra-short items to wide rows with the last reported value as text."""
    value = "obsrValue" if "obsrValue" in items.columns else "fcstValue"
    keys = [*by, *[c for c in (*BASE_KEYS, *KEYS) if c in items.columns]]
    return pivot_last(items, keys, categories, value, order)


def nowcast_at_base_time(nowcast: DataFrame) -> DataFrame:
    """Let nowcast rows, which carry only a base time, hold for the hour of that time."""
    return nowcast.withColumns(
        {"fcstDate": F.col("baseDate"), "fcstTime": time_text(F.col("baseTime"))}
    )


def union_feeds(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack parts whose columns may differ; what a part lacks is null."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked
