"""Newest data at or before a point in time, within a tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galecast.functions.clock import BASE_TRIES, forecast_clock, plus_hours
from galecast.operators.keys import newest_rows

LOOKBACK_HOURS = 48


def asof(
    df: DataFrame, keys: Sequence[str], time: str, anchor: Column, back_hours: int
) -> DataFrame:
    """All rows of each key's newest ``time`` in ``[anchor - back_hours, anchor]``."""
    within = df.where(F.col(time).between(plus_hours(anchor, -back_hours), anchor))
    return newest_rows(within, keys, time)


def latest_base(
    items: DataFrame, newest: Column, tries: int = BASE_TRIES, keys: Sequence[str] = ("nx", "ny")
) -> DataFrame:
    """The items of each cell's newest base, looking back ``tries`` bases from ``newest``.

    Bases are an hour apart. ``newest`` is the one published last:
    ``clock.nowcast_base`` (on the hour) or ``clock.forecast_base`` (on the half
    hour) of the time of asking.
    """
    based = items.withColumn("base_ts", forecast_clock(F.col("baseDate"), F.col("baseTime")))
    on_step = based.where(F.minute("base_ts") == F.minute(newest))
    return asof(on_step, keys, "base_ts", newest, tries - 1)


def asof_rows(
    asked: DataFrame, known: DataFrame, keys: Sequence[str], at: str, time: str, values: Sequence[str], back_hours: int
) -> DataFrame:
    """Every row of ``asked`` with the ``time`` and ``values`` of the newest row of ``known`` at or before its own ``at``.

    Each row has its own anchor, and all are served by one plan: both tables are
    put in one, cut into days, and the last row of a key is carried on; what lies
    before the day comes from a summary with one row per key and day. So a key
    with most of the rows is spread over its days, and there is no range join.
    Null where nothing lies in the ``back_hours`` before. Of rows of ``known``
    with equal key and time the largest counts. Rows without a key or an ``at``
    find nothing.
    """
    keys, values = list(keys), list(values)
    own = [f"_a{i}" for i in range(len(asked.columns))]  # own names: those of both tables may clash
    by = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    found = F.struct(F.col(time).alias("time"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    right = known.where(reduce(and_, [F.col(c).isNotNull() for c in [*keys, time]])).select(*by, F.col(time).alias("_t"), found.alias("_r"))
    left = asked.select(*by, F.col(at).alias("_t"), F.struct(*[F.col(c).alias(a) for c, a in zip(asked.columns, own)]).alias("_l"))
    both = right.withColumn("_l", F.lit(None).cast(left.schema["_l"].dataType)).unionByName(
        left.withColumn("_r", F.lit(None).cast(right.schema["_r"].dataType))
    ).withColumn("_day", F.col("_t").cast("date"))

    running = (Window.unboundedPreceding, Window.currentRow)
    within = Window.partitionBy(*names, "_day").orderBy("_t", F.col("_l").isNotNull(), "_r").rowsBetween(*running)
    near = both.withColumn("_near", F.last("_r", ignorenulls=True).over(within)).where(F.col("_l").isNotNull())
    days = both.groupBy(*names, "_day").agg(F.max("_r").alias("_max"))
    earlier = Window.partitionBy(*names).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(*[F.col(n).alias(f"{n}d") for n in names], F.col("_day").alias("_dayd"), F.last("_max", ignorenulls=True).over(earlier).alias("_before"))
    same = reduce(and_, [F.col(n) == F.col(f"{n}d") for n in names] + [F.col("_day") == F.col("_dayd")])
    placed = near.join(days, same, "left").withColumn("_f", F.coalesce("_near", "_before"))
    recent = F.col("_f.time") >= plus_hours(F.col("_t"), -back_hours)
    known_key = reduce(and_, [F.col(n).isNotNull() for n in names])
    kept = placed.withColumn("_f", F.when(recent & known_key, F.col("_f")))
    return kept.select(
        *[F.col("_l").getField(a).alias(c) for a, c in zip(own, asked.columns)], F.col("_f.time").alias(time),
        *[F.col("_f").getField(f"v{i}").alias(v) for i, v in enumerate(values)],
    )
