"""Exact percentiles of many scopes and measures, without holding a scope in one task.

Spark's ``percentile`` keeps all distinct values of a group in one buffer. A
run may hold a third of the table, so all measures of all scopes are counted in
one aggregate of ``(scope, measure, value)``, spread over all tasks. The
distinct values are then range-partitioned once; every partition says which
interval of values it holds and how many rows these stand for, so the sums over
earlier intervals are the ranks at which an interval begins. Only values of
intervals in which a wanted rank lies are put in order. The intervals hold about
equally many distinct values, whatever the values are, so an outlier or a value
with most of the rows does not fill one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galecast.operators.keys import splittable

# Ranges per shuffle partition: a task orders a small share of what it counted.
RANGES_PER_PARTITION = 4

# The usual scope: the run hour, yyyyMMddHH.
RUN = ("dt",)

#: A measure: its values, the shares wanted, and the names of the results.
Measure = tuple[Column, Sequence[float], Sequence[str]]


def join_scope(df: DataFrame, table: DataFrame, scope: Sequence[str], how: str = "left", few: bool = False) -> DataFrame:
    """Add a table with one row per scope to a table of any size.

    With no scope columns it is a single row, which the plan takes in as a value.
    Otherwise Spark chooses the join by size: the table is broadcast while it is
    below the threshold, and beyond it full partitions are split. ``few`` says
    that scopes are few, such as runs: behind an aggregate Spark takes them for
    many and would gather every run of ``df`` in one task before it knows.
    """
    scope = list(scope)
    if not scope:
        names = table.columns
        row = df.withColumn("_row", table.select(F.struct(*names)).scalar())
        return row.select(*df.columns, *[F.col("_row").getField(n).alias(n) for n in names])
    return df.join(F.broadcast(table) if few else splittable(table, scope), scope, how)


def counted_values(df: DataFrame, scope: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """``_m`` (number of the measure), ``_v`` and ``_n``: how often each finite value of each measure occurs in each scope."""
    each = [
        F.struct(F.lit(k).alias("_m"), F.when(v.isNotNull() & (F.abs(v) < float("inf")), v).alias("_v"))
        for k, v in enumerate(values)
    ]
    long = df.select(*scope, F.explode(F.array(*each)).alias("_x")).select(*scope, "_x._m", "_x._v")
    return long.where("_v IS NOT NULL").groupBy(*scope, "_m", "_v").agg(F.count("*").alias("_n"))


def value_ranges(counted: DataFrame, scope: Sequence[str], ranges: int) -> DataFrame:
    """Intervals of values in order: ``_low``, ``_high``, ``_count`` (rows), ``_values`` (distinct), ``_before`` (rows before it), ``_size`` (rows of the measure).

    There are at most ``ranges`` intervals more than scopes and measures, few
    enough for one task to sum up.
    """
    placed = counted.repartitionByRange(ranges, *scope, "_m", "_v").withColumn("_at", F.spark_partition_id())
    intervals = placed.groupBy(*scope, "_m", "_at").agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_n").alias("_count"), F.count("*").alias("_values")
    )
    all_of = Window.partitionBy(*scope, "_m")
    earlier = all_of.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    return intervals.coalesce(1).withColumns(
        {"_before": F.coalesce(F.sum("_count").over(earlier), F.lit(0)), "_size": F.sum("_count").over(all_of)}
    ).drop("_at")


def scope_statistics(
    df: DataFrame, scope: Sequence[str], measures: Sequence[Measure], flags: Mapping[str, Column] = {}
) -> DataFrame:
    """One row per scope: percentiles of several measures, interpolated between ranks, and flags.

    Null and infinite values do not count; a scope without any value or flag
    has no row. A flag is true if it is in any row of the scope, else null.
    ``scope`` columns must not be null; without any, the whole table is one
    scope and has one row even when it has no values.
    """
    scope = list(scope)
    values = [v for v, _, _ in measures] + [F.when(f, F.lit(0.0)) for f in flags.values()]
    counted = counted_values(df, scope, values)
    ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    intervals = value_ranges(counted, scope, ranges)

    def ranks(k: int) -> list[Column]:
        at = [F.lit(float(p)) * (F.col("_size") - 1) for p in measures[k][1]]
        return [f(x).cast("long") for x in at for f in (F.floor, F.ceil)]

    def inside(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_count"))

    hit = F.col("_m") >= len(measures)
    for k in range(len(measures)):
        for rank in ranks(k):
            hit = hit | ((F.col("_m") == k) & inside(rank))
    wanted = intervals.where(hit).select(*scope, "_m", "_low", "_high", "_before", "_size")

    # Only the values of those intervals are put in order: at most two intervals per percentile.
    named = wanted.withColumnsRenamed({c: f"_w{c}" for c in [*scope, "_m"]})
    same = (F.col("_m") == F.col("_w_m")) & F.col("_v").between(F.col("_low"), F.col("_high"))
    for c in scope:
        same = same & (F.col(c) == F.col(f"_w{c}"))
    chosen = counted.join(splittable(named, [f"_w{c}" for c in [*scope, "_m"]]), same)
    together = chosen.repartition(*scope) if scope else chosen.repartition(1)
    running = Window.partitionBy(*scope, "_m", "_low").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = together.withColumn("_upto", F.col("_before") + F.sum("_n").over(running))

    def at(k: int, rank: Column) -> Column:
        here = (F.col("_m") == k) & (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
        return F.max(F.when(here, F.col("_v")))

    found: list[Column] = []
    for k in range(len(measures)):
        found.append(F.max(F.when(F.col("_m") == k, F.col("_size"))).alias(f"_size{k}"))
        found += [at(k, rank).alias(f"_v{k}_{i}") for i, rank in enumerate(ranks(k))]
    found += [F.max(F.when(F.col("_m") == len(measures) + i, F.lit(True))).alias(name) for i, name in enumerate(flags)]
    edges = ordered.groupBy(*scope).agg(*found)
    result = []
    for k, (_, shares, names) in enumerate(measures):
        for i, (p, name) in enumerate(zip(shares, names)):
            position = F.lit(float(p)) * (F.col(f"_size{k}") - 1)
            low, high = F.col(f"_v{k}_{2 * i}"), F.col(f"_v{k}_{2 * i + 1}")
            result.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return edges.select(*scope, *result, *flags)


def scope_percentiles(
    df: DataFrame, value: Column, scope: Sequence[str], shares: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """One row per scope: the percentiles ``shares`` of ``value``; see ``scope_statistics``."""
    return scope_statistics(df, scope, [(value, shares, names)])
