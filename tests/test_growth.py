"""Work per row that must not grow with what a run or a key needs once."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from galecast.operators.coalesce import KEYS
from galecast.operators.keys import newest_per_key
from galecast.plans import bronze, silver


def landed(spark, *items):
    """Stored items: run, cell, issue, target date, target time, category, value."""
    rows = [
        ("short_fcst", nx, 60, None, None, i, "good", None, 0,
         {"baseDate": run[:8], "baseTime": base, "fcstDate": day, "fcstTime": time, "category": what, "fcstValue": value}, run, 0, "short_fcst")
        for i, (run, nx, base, day, time, what, value) in enumerate(items)
    ]
    return spark.createDataFrame(rows, bronze.STORED)


def short_rows(spark):
    return landed(
        spark,
        ("2025081516", 40, "1400", "20250815", "1600", "TMP", "21"),  # the hour of the poll
        ("2025081516", 40, "1400", "20250815", "1500", "TMP", "20"),  # after the issue, before the poll
        ("2025081516", 41, "1400", "20250815", "1500", "TMP", "19"),  # only after the issue: the fallback
        ("2025081516", 42, "1400", "20250815", "2200", "TMP", "18"),  # beyond the horizon
        ("2025082516", 42, "1400", "20250825", "1700", "PCP", "1mm 미만"),
    )


def test_times_of_a_poll_are_not_worked_out_in_filters_of_items(spark):
    calls = spark.createDataFrame([(40, 60, "7"), (41, 60, "8"), (42, 60, "9")], "nx int, ny int, admin_code string")
    polls = bronze.poll_times(spark, ["2025081516", "2025082516", "2025081516"])
    feed = bronze.short_feed(short_rows(spark), calls, polls)
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line and "fcstTime" in line]
    assert filters and not any("lambdafunction" in line or "make_timestamp" in line for line in filters)
    found = {(r["dt"], r["nx"], r["fcstTime"]): (r["admin_code"], r["TMP"], r["PCP"]) for r in feed.collect()}
    assert found == {
        ("2025081516", 40, "1600"): (7, 21.0, None), ("2025081516", 41, "1500"): (8, 19.0, None),
        ("2025082516", 42, "1700"): (9, None, 0.5),
    }


def wide_feed(spark, n, **values):
    keys = [(F.col("id") % 7).cast("int").alias("nx"), (F.col("id") % 11).cast("int").alias("ny"), F.lit("20250801").alias("fcstDate"),
            F.when(F.col("id") % 13 > 0, "0300").alias("fcstTime")]
    return spark.range(n).select(*keys, F.col("id").alias("seq"), *[v.alias(c) for c, v in values.items()])


def test_merge_sorts_by_a_hash_of_the_key_first(spark):
    feeds = {
        "ultra_shortfcst": wide_feed(spark, 3000, T1H=F.col("id") * 1.0, WSD=F.lit(None).cast("double")),
        "short_fcst": wide_feed(spark, 1500, WSD=F.col("id") * 2.0),
    }
    merged = silver.merge(feeds, order_by=["seq"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    sorts = re.findall(r"Sort \[(\w+)#", plan)
    assert sorts and set(sorts) == {"_key_hash"}
    assert merged.columns == [*KEYS, "seq", "T1H", "WSD"]
    base = {r[:4]: r for r in map(tuple, newest_per_key(feeds["ultra_shortfcst"], KEYS, ["seq"]).collect())}
    right = {r[:4]: r[5] for r in map(tuple, newest_per_key(feeds["short_fcst"], KEYS, ["seq"]).collect())}
    expected = {k: (*r[:6], None if k[3] is None else right.get(k)) for k, r in base.items()}
    found = [tuple(r) for r in merged.collect()]
    assert len(found) == len(base) and {r[:4]: r for r in found} == expected
