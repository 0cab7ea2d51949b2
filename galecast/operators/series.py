"""Irregular time series brought to given times.

A series is a set of columns; its points have a wall-clock time and values that
may be null one by one. Points and wanted times are put in one table and each
time looks up its neighbours. The table is cut into days, so that a series with
most of the points is spread over many tasks; what lies beyond a day comes from
a summary with one row per series and day.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galecast.functions.clock import epoch_seconds, plus_hours
from galecast.operators.percentiles import join_scope

CLAMP = "clamp"
INSIDE = "inside"


def interpolate(
    points: DataFrame,
    targets: DataFrame,
    series: Sequence[str],
    values: Sequence[str],
    time: str = "time",
    edges: str = CLAMP,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``targets`` (series and time) with the values of ``points``, linear in time.

    Before the first and after the last point of a value the nearest one holds
    (``clamp``) or the result is null (``inside``). A series without points is
    null. Points must be unique per series and time. Rows without a series or a
    time drop out. ``carry`` names further columns of the targets to keep.
    """
    if edges not in (CLAMP, INSIDE):
        raise ValueError(f"edges must be {CLAMP!r} or {INSIDE!r}")
    series, values = list(series), list(values)
    knot = [
        F.when(F.col(v).isNotNull(), F.struct(F.col(time).alias("t"), F.col(v).cast("double").alias("v"))).alias(v)
        for v in values
    ]
    no_knot = [F.lit(None).cast("struct<t:timestamp_ntz,v:double>").alias(v) for v in values]
    asked = F.col("_asked")
    nothing = [F.lit(None).cast(targets.schema[c].dataType).alias(c) for c in carry]
    both = points.select(*series, time, F.lit(False).alias("_asked"), *knot, *nothing).unionByName(
        targets.select(*series, time, F.lit(True).alias("_asked"), *no_knot, *carry)
    ).withColumn("_day", F.col(time).cast("date"))
    # Said here, these filters are the same for both uses of the table, which can
    # then share one shuffle; otherwise Spark adds them on one side only.
    both = both.where(reduce(and_, [F.col(c).isNotNull() for c in [*series, "_day"]]))

    # Nearest point within the day, on either side. Both ways are running
    # windows: a frame that reaches to the end would be read again for each row.
    running = (Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy(*series, "_day").orderBy(time, "_asked").rowsBetween(*running)
    ahead = (
        Window.partitionBy(*series, "_day").orderBy(F.desc(time), F.desc("_asked")).rowsBetween(*running)
    )
    near = both.select(
        *series, time, "_day", "_asked", *carry,
        *[F.last(v, ignorenulls=True).over(back).alias(f"_p_{v}") for v in values],
        *[F.last(v, ignorenulls=True).over(ahead).alias(f"_n_{v}") for v in values],
    ).where(asked)

    # Nearest point in other days: one row per series and day.
    days = both.groupBy(*series, "_day").agg(
        *[F.max(v).alias(f"_l_{v}") for v in values], *[F.min(v).alias(f"_f_{v}") for v in values]
    )
    earlier = (Window.unboundedPreceding, -1)
    before = Window.partitionBy(*series).orderBy("_day").rowsBetween(*earlier)
    after = Window.partitionBy(*series).orderBy(F.desc("_day")).rowsBetween(*earlier)
    days = days.select(
        *series, "_day",
        *[F.last(f"_l_{v}", ignorenulls=True).over(before).alias(f"_b_{v}") for v in values],
        *[F.last(f"_f_{v}", ignorenulls=True).over(after).alias(f"_a_{v}") for v in values],
    )

    # Every day is in both.
    placed = near.join(days, [*series, "_day"]).select(
        *series, time, *carry,
        *[F.coalesce(f"_p_{v}", f"_b_{v}").alias(f"_p_{v}") for v in values],
        *[F.coalesce(f"_n_{v}", f"_a_{v}").alias(f"_n_{v}") for v in values],
    )
    at = epoch_seconds(F.col(time))

    def between(v: str):
        p, n = F.col(f"_p_{v}"), F.col(f"_n_{v}")
        p_at, n_at = epoch_seconds(p["t"]), epoch_seconds(n["t"])
        line = p["v"] + (n["v"] - p["v"]) * ((at - p_at) / (n_at - p_at))
        exact = p["t"] == F.col(time)
        if edges == CLAMP:
            return F.when(exact | n.isNull(), p["v"]).when(p.isNull(), n["v"]).otherwise(line)
        return F.when(exact, p["v"]).when(p.isNotNull() & n.isNotNull(), line)

    return placed.select(*series, time, *carry, *[between(v).alias(v) for v in values])


def resample_hourly(
    points: DataFrame, series: Sequence[str], values: Sequence[str], time: str = "time"
) -> DataFrame:
    """Each series at full hours counted from its first point, up to its last.

    A series with a single time keeps it unchanged. Points must be unique per
    series and time. Windows run over the points alone: every point knows the
    one after it and the values on either side, and brings the hours between.
    """
    series, values = list(series), list(values)
    known = [
        F.when(F.col(v).isNotNull(), F.struct(F.col(time).alias("t"), F.col(v).cast("double").alias("v"))).alias(v)
        for v in values
    ]
    rows = points.select(*series, F.col(time).alias("_t"), F.col(time).cast("date").alias("_day"), *known)
    rows = rows.where(reduce(and_, [F.col(c).isNotNull() for c in [*series, "_day"]]))

    # Within the day, by running windows over the points alone.
    running = (Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy(*series, "_day").orderBy("_t")
    ahead = Window.partitionBy(*series, "_day").orderBy(F.desc("_t"))
    near = rows.select(
        *series, "_t", "_day", F.lead("_t").over(back).alias("_next"),
        *[F.last(v, ignorenulls=True).over(back.rowsBetween(*running)).alias(f"_p_{v}") for v in values],
        *[F.last(v, ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_n_{v}") for v in values],
    )

    # Beyond it, from one row per series and day.
    days = rows.groupBy(*series, "_day").agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_last"),
        *[F.max(v).alias(f"_l_{v}") for v in values], *[F.min(v).alias(f"_f_{v}") for v in values]
    )
    of_series = Window.partitionBy(*series)
    before = of_series.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    after = of_series.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(
        *series, "_day",
        F.min("_first").over(of_series).alias("_start"),
        F.lead("_first").over(of_series.orderBy("_day")).alias("_next_day"),
        *[F.last(f"_l_{v}", ignorenulls=True).over(before).alias(f"_b_{v}") for v in values],
        *[F.last(f"_f_{v}", ignorenulls=True).over(after).alias(f"_a_{v}") for v in values],
    )
    placed = near.join(days, [*series, "_day"]).select(
        *series, "_t", "_start", F.coalesce("_next", "_next_day").alias("_next"),
        *[F.coalesce(f"_p_{v}", f"_b_{v}").alias(f"_p_{v}") for v in values],
        *[F.coalesce(f"_n_{v}", f"_a_{v}").alias(f"_n_{v}") for v in values],
    )

    # The full hours from a point up to, not including, the next one; of the last point only its own.
    hour = 3_600_000_000

    def full_hours(at: Column) -> Column:
        return F.ceil(F.timestamp_diff("MICROSECOND", F.col("_start"), at) / hour).cast("int")

    own = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("_t")) % hour == 0
    last = F.when(F.col("_next").isNotNull(), full_hours(F.col("_next")) - 1).when(own, full_hours(F.col("_t")))
    steps = F.when(last >= full_hours(F.col("_t")), F.sequence(full_hours(F.col("_t")), last))
    hourly = placed.withColumn("_k", F.explode(steps)).withColumn(time, plus_hours(F.col("_start"), F.col("_k")))

    def between(v: str) -> Column:
        p, n, at = F.col(f"_p_{v}"), F.col(f"_n_{v}"), epoch_seconds(F.col(time))
        p_at, n_at = epoch_seconds(p["t"]), epoch_seconds(n["t"])
        line = p["v"] + (n["v"] - p["v"]) * ((at - p_at) / (n_at - p_at))
        return F.when(p["t"] == F.col(time), p["v"]).when(p.isNotNull() & n.isNotNull(), line)

    return hourly.select(*series, time, *[between(v).alias(v) for v in values])


def interpolate_on_hours(
    points: DataFrame, targets: DataFrame, series: Sequence[str], values: Sequence[str], time: str = "time"
) -> DataFrame:
    """``targets`` with the values they have when each series is resampled hourly first, ends held.

    The same as ``interpolate(resample_hourly(points), targets)`` without the
    hours between: a target lies between two steps of its series, counted from
    the first point, and only these two are looked up. Steps at which a value is
    not known are passed over towards the nearest that has it. Targets must be
    unique per series and time.
    """
    series, values = list(series), list(values)
    known = {v: F.when(F.col(v).isNotNull(), F.col(time)) for v in values}
    span = points.groupBy(*series).agg(
        F.min(time).alias("_start"), *[f(c).alias(f"_{n}_{v}") for v, c in known.items() for n, f in (("a", F.min), ("z", F.max))]
    )
    hour = 3_600_000_000

    def steps(at: str) -> Column:
        return F.timestamp_diff("MICROSECOND", F.col("_start"), F.col(at)) / hour

    spanned = join_scope(targets.select(*series, time), span, series)
    bounds = [steps(time).alias("x"), F.col(time).alias("at")]
    for v in values:
        first, last = F.ceil(steps(f"_a_{v}")), F.floor(steps(f"_z_{v}"))
        below = F.least(F.greatest(F.floor(steps(time)), first), last)
        there = first <= last
        bounds += [F.when(there, below).alias(f"lo_{v}"), F.when(there, F.greatest(F.least(below + 1, last), first)).alias(f"hi_{v}")]
    placed = spanned.select(*series, "_start", F.struct(*bounds).alias("_b"))
    wanted = F.array_distinct(F.array_compact(F.array(*[F.col(f"_b.{s}_{v}") for v in values for s in ("lo", "hi")])))
    asked = placed.withColumn("_k", F.explode(F.when(F.size(wanted) > 0, wanted).otherwise(F.array(F.lit(0).cast("long")))))
    step = plus_hours(F.col("_start"), F.col("_k").cast("int"))
    asked = asked.select(*series, F.coalesce(step, F.col("_b.at")).alias(time), "_b", "_k")
    found = interpolate(points, asked, series, values, time, INSIDE, ["_b", "_k"])
    ends = found.groupBy(*series, "_b").agg(
        *[F.max(F.when(F.col("_k") == F.col(f"_b.{s}_{v}"), F.col(v))).alias(f"{s}_{v}") for v in values for s in ("lo", "hi")]
    )

    def between(v: str) -> Column:
        low, high, share = F.col(f"lo_{v}"), F.col(f"hi_{v}"), F.col("_b.x") - F.col(f"_b.lo_{v}")
        inside = (share > 0) & (F.col(f"_b.hi_{v}") > F.col(f"_b.lo_{v}"))
        return F.when(inside, low + (high - low) * share).otherwise(low)

    return ends.select(*series, F.col("_b.at").alias(time), *[between(v).alias(v) for v in values])
