from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from galecast.operators import storm
from galecast.operators.series import interpolate, interpolate_on_hours, resample_hourly
from tests.test_plans import NO_BROADCAST, final_plan, settings

VALUES = ["lat", "wind"]
SCHEMA = "storm string, time timestamp_ntz, lat double, wind double"


def points(spark):
    rng = random.Random(6)
    start = dt.datetime(2025, 8, 1)
    rows = []
    for name, n in (("long", 40), ("one", 1), ("two", 2), ("windless", 12), ("gusty", 12)):
        times = sorted({start + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 3)) for _ in range(n)})
        for i, t in enumerate(times):
            wind = None if name == "windless" or (name == "gusty" and i not in (4, 5, 8)) else rng.uniform(5, 50)
            rows.append((name, t, rng.uniform(20, 40), wind))
    rows.append(("single gust", start, 30.0, None))
    rows.append(("single gust", start + dt.timedelta(minutes=30), 30.5, 9.0))
    rows.append(("single gust", start + dt.timedelta(hours=3), 31.0, None))
    return spark.createDataFrame(rows, SCHEMA)


def targets(spark, names):
    start = dt.datetime(2025, 7, 31, 22)
    hours = [start + dt.timedelta(hours=h) for h in range(0, 80, 3)] + [start + dt.timedelta(minutes=m) for m in range(7, 4000, 411)]
    return spark.createDataFrame([(n, t) for n in names for t in hours], "storm string, time timestamp_ntz")


def rows_of(df):
    return sorted(
        ((r.storm, r.time, *[None if r[v] is None else round(r[v], 6) for v in VALUES]) for r in df.collect()), key=repr
    )


def test_the_hours_between_are_not_needed(spark):
    known = points(spark)
    wanted = targets(spark, ["long", "one", "two", "windless", "gusty", "single gust", "never seen"])
    through = interpolate(resample_hourly(known, ["storm"], VALUES), wanted, ["storm"], VALUES)
    found = rows_of(interpolate_on_hours(known, wanted, ["storm"], VALUES))
    assert found == rows_of(through) and len(found) == wanted.count()
    assert any(r[0] == "gusty" and r[3] is not None for r in found) and all(r[3] is None for r in found if r[0] == "windless")


def test_one_series_without_a_name(spark):
    known = points(spark).where("storm = 'long'").drop("storm")
    wanted = targets(spark, ["x"]).drop("storm")
    found = interpolate_on_hours(known, wanted, [], VALUES).withColumn("storm", F.lit("x"))
    through = interpolate(resample_hourly(known, [], VALUES), wanted, [], VALUES).withColumn("storm", F.lit("x"))
    assert rows_of(found) == rows_of(through)
    nothing = interpolate_on_hours(known.limit(0), wanted, [], VALUES).collect()
    assert len(nothing) == wanted.count() and all(r.lat is None for r in nothing)


def test_one_track_is_read_once(spark, tmp_path):
    points(spark).withColumn("lon", F.lit(130.0)).write.parquet(str(tmp_path / "track"))
    known = storm.one_point_per_time(spark.read.parquet(str(tmp_path / "track")).drop("storm"))
    wanted = targets(spark, ["long"]).select("time").distinct()
    with settings(spark, **NO_BROADCAST):
        plan = final_plan(storm.positions_at(known, wanted))
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "Reused" not in x]
    assert len(shuffles) <= 5 and "explode(sequence" not in plan


def test_hours_are_resampled_from_windows_over_the_points(spark):
    rows = [("a", f"2025-08-0{d} {h:02}:{m:02}:00", v, w) for d, h, m, v, w in (
        (1, 0, 20, 1.0, None), (1, 3, 20, None, 5.0), (1, 3, 50, 4.0, None), (2, 1, 0, None, None), (4, 2, 20, 9.0, 7.0), (4, 2, 30, 2.0, 8.0))]
    rows += [("b", "2025-08-01 05:07:00", 3.0, None), (None, "2025-08-01 05:07:00", 3.0, None), ("c", None, 3.0, None)]
    known = spark.createDataFrame(rows, "storm string, time string, lat double, lon double").withColumn("time", F.col("time").cast("timestamp_ntz"))
    got = resample_hourly(known, ["storm"], ["lat", "lon"])
    hours = known.groupBy("storm").agg(F.min("time").alias("a"), F.max("time").alias("z")).select(
        "storm", F.explode(F.sequence("a", "z", F.expr("INTERVAL 1 HOUR"))).alias("time")
    )
    wanted = interpolate(known, hours, ["storm"], ["lat", "lon"], edges="inside")
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    assert got.count() == 76
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()  # hours meet no window
