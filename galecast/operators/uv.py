"""UV index anchors to hourly values per cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.functions.clock import plus_hours
from galecast.functions.numeric import number_from_text
from galecast.operators.asof import LOOKBACK_HOURS, asof
from galecast.operators.series import interpolate
from galecast.operators.slots import slot_columns

# Names of a single index value, first and last hour of daylight.
SINGLE_NAMES = ("uvi", "uvIndex", "idx", "value")
DAYLIGHT_HOURS = (6, 20)
OFFSET_PATTERN = r"^[hH](\d{1,2})$"


def offsets(items: DataFrame, order: str = "seq", by: Sequence[str] = ()) -> DataFrame:
    """``item`` maps to one value per area, base and hour offset; the later item wins.

    Keys ``h0``, ``h3``, ... give the offsets. An item without any of them may
    hold a single value, which stands for offset 0.
    """
    hourly = F.filter(
        F.map_entries("item"),
        lambda e: e["key"].rlike(OFFSET_PATTERN) & number_from_text(e["value"]).isNotNull(),
    )
    single = F.coalesce(*[number_from_text(F.try_element_at("item", F.lit(n))) for n in SINGLE_NAMES])
    alone = F.when(
        single.isNotNull(),
        F.array(F.struct(F.lit("h0").alias("key"), single.cast("string").alias("value"))),
    )
    entries = items.select(*by, "admin_code", "base_ts", order, hourly.alias("_hourly"), alone.alias("_alone"))
    values = entries.select(
        *by, "admin_code", "base_ts", order,
        F.explode(F.when(F.size("_hourly") > 0, F.col("_hourly")).otherwise(F.col("_alone"))).alias("e"),
    ).select(
        *by, "admin_code", "base_ts", order,
        F.regexp_extract("e.key", OFFSET_PATTERN, 1).cast("int").alias("offset"),
        number_from_text(F.col("e.value")).alias("value"),
    )
    return values.groupBy(*by, "admin_code", "base_ts", "offset").agg(
        F.max_by("value", F.struct(order, "value")).alias("value")
    )


def newest_base(offset_values: DataFrame, anchor: Column, back_hours: int = LOOKBACK_HOURS) -> DataFrame:
    """The offsets of each area's newest base at or before the anchor that has any."""
    return asof(offset_values, ["admin_code"], "base_ts", anchor, back_hours)


def hourly_index(based: DataFrame, targets: DataFrame) -> DataFrame:
    """Index per area at the target hours (``ts``): interpolated, 0 at night, whole numbers.

    The targets are the few hours of one horizon and go to the areas as one value.
    """
    knots = based.select(
        "admin_code",
        plus_hours(F.col("base_ts"), F.col("offset")).alias("time"),
        F.col("value").alias("UVI"),
    )
    hours = targets.agg(F.array_sort(F.collect_set("ts"))).scalar()
    asked = based.select("admin_code").distinct().withColumn("time", F.explode(hours))
    filled = interpolate(knots, asked, ["admin_code"], ["UVI"])
    return filled.select("admin_code", "time", daylight_index(F.col("time"), F.col("UVI")).alias("UVI"))


def daylight_index(time: Column, value: Column) -> Column:
    """0 at night, else a whole number that is not negative."""
    day = F.hour(time).between(*DAYLIGHT_HOURS)
    return F.greatest(F.bround(F.when(day, value).otherwise(0.0)), F.lit(0.0)).cast("int")


def uv_feed_of_runs(
    items: DataFrame, calls: DataFrame, targets: DataFrame, run: str, order: str = "seq", back_hours: int = LOOKBACK_HOURS
) -> DataFrame:
    """The UV feed of many runs in one plan: every run has its own targets (``run``, ``ts``) and the anchor that follows from them."""
    areas = calls.select("admin_code").distinct()
    listed = targets.groupBy(run).agg(F.min("ts").alias("_anchor"), F.array_sort(F.collect_set("ts")).alias("_hours"))  # one horizon a run
    values = offsets(items.join(areas, "admin_code", "left_semi"), order, [run]).join(listed, run)
    based = asof(values, [run, "admin_code"], "base_ts", F.col("_anchor"), back_hours)
    knots = based.select(
        run, "admin_code", plus_hours(F.col("base_ts"), F.col("offset")).alias("time"), F.col("value").alias("UVI")
    )
    asked = based.select(run, "admin_code", "_hours").distinct().select(run, "admin_code", F.explode("_hours").alias("time"))
    filled = interpolate(knots, asked, [run, "admin_code"], ["UVI"])
    cells = calls.select("admin_code", "nx", "ny")
    return filled.join(cells, "admin_code").select(
        run, "nx", "ny", *[c.alias(n) for n, c in slot_columns(F.col("time")).items()],
        daylight_index(F.col("time"), F.col("UVI")).alias("UVI"),
    )


def fan_out(index: DataFrame, calls: DataFrame) -> DataFrame:
    """The values of an area for each of its cells: the UV feed."""
    cells = calls.select("admin_code", "nx", "ny")
    return index.join(cells, "admin_code").select(
        "nx", "ny", *[c.alias(n) for n, c in slot_columns(F.col("time")).items()], "UVI"
    )


def build_uv_feed(
    items: DataFrame, calls: DataFrame, targets: DataFrame, order: str = "seq",
    back_hours: int = LOOKBACK_HOURS,
) -> DataFrame:
    """Index items, call list and target hours (``ts``) to the UV feed."""
    areas = calls.select("admin_code").distinct()
    anchor = targets.agg(F.min("ts")).scalar()
    known = items.join(areas, "admin_code", "left_semi")
    based = newest_base(offsets(known, order), anchor, back_hours)
    return fan_out(hourly_index(based, targets), calls)
