"""Operators on small tables, against brute force and worked results."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from galecast.functions import clock
from galecast.functions.scores import percentile_scale
from galecast.operators import asof, regions, series, slots, storm, uv, wide
from galecast.operators.canonical import canonicalize
from galecast.operators.coalesce import Feed, coalesce_join, merge_feeds
from galecast.operators.keys import first_per_key, newest_per_key, newest_rows
from galecast.operators.percentiles import scope_percentiles

START = dt.datetime(2025, 8, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- keys and joins --------------------------------------------------------


def test_newest_per_key_is_whole_and_independent_of_order(spark):
    data = [(k % 3, i % 7, (i * 37) % 11, None if i % 5 == 0 else float(i)) for i in range(200) for k in [i]]
    want = {}
    for k, s, a, b in data:
        key = (s, a, float("-inf") if b is None else b)
        if k not in want or key > want[k][0]:
            want[k] = (key, (k, s, a, b))
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "k int, s int, a int, b double").repartition(5)
        assert rows(newest_per_key(df, ["k"], ["s"])) == sorted((v[1] for v in want.values()), key=repr)


def test_first_per_key_and_newest_rows(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 9), (2, "c", 1), (2, "c", 1)], "k int, c string, v int")
    assert rows(first_per_key(df, ["k"], ["c"])) == [(1, "a", 9), (2, "c", 1)]
    assert rows(newest_rows(df, ["k"], "v")) == [(1, "a", 9), (2, "c", 1), (2, "c", 1)]


BASE = "nx int, ny int, fcstDate string, fcstTime string, T1H double, WSD double"


def test_coalesce_join_fills_only_what_is_missing(spark):
    base = spark.createDataFrame(
        [(1, 1, "20250801", "0000", 20.0, None), (1, 1, "20250801", "0000", None, 2.0), (2, 1, "20250801", "0000", None, None)],
        BASE,
    )
    right = spark.createDataFrame(
        [(1, 1, "20250801", "0000", 5.0, 30.0, "0100"), (1, 1, "20250801", "0000", 6.0, None, "0200")],
        "nx int, ny int, fcstDate string, fcstTime string, WSD double, POP double, baseTime string",
    )
    joined = coalesce_join(base, right, ["WSD", "POP"])
    assert joined.columns == [*base.columns, "POP"]
    assert joined.count() == base.count()
    assert rows(joined.select("nx", "T1H", "WSD", "POP")) == sorted(
        [(1, 20.0, 6.0, None), (1, None, 2.0, None), (2, None, None, None)], key=repr
    )


def test_absent_or_keyless_feeds_change_nothing(spark):
    base = spark.createDataFrame([(1, 1, "20250801", "0000", 20.0, None)], BASE)
    keyless = spark.createDataFrame([(1, 1, 5.0)], "nx int, ny int, WSD double")
    merged = merge_feeds(base, [Feed("a", None, ["POP"]), Feed("b", keyless, ["WSD"])])
    assert merged.columns == base.columns
    assert rows(merged) == rows(base)


def test_earlier_feeds_win(spark):
    key = (1, 1, "20250801", "0000")
    base = spark.createDataFrame([(*key, None, None)], BASE)
    feeds = [
        Feed("a", spark.createDataFrame([(*key, None, 1.0)], BASE), ["T1H", "WSD"]),
        Feed("b", spark.createDataFrame([(*key, 3.0, 2.0)], BASE), ["T1H", "WSD"]),
    ]
    assert rows(merge_feeds(base, feeds).select("T1H", "WSD")) == [(3.0, 1.0)]


def test_canonicalize(spark):
    df = spark.createDataFrame(
        [("61", "2025-08-01", "3:00", "강수없음", float("nan"), "keep"), ("x", "20250801", "300", "1mm 미만", 2.0, None)],
        "nx string, fcstDate string, fcstTime string, RN1 string, WSD double, other string",
    )
    assert rows(canonicalize(df)) == sorted(
        [(61, "20250801", "0300", None, None, "keep"), (None, "20250801", "0300", None, 2.0, None)], key=repr
    )
    read = canonicalize(df, read_amount_text=True).select("RN1")
    assert sorted(r[0] for r in read.collect()) == [0.0, 0.5]


# ---- percentiles -----------------------------------------------------------


def percentiles(spark, groups):
    data = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "dt string, v double").repartition(4)
    found = scope_percentiles(df, F.col("v"), ["dt"], (0.05, 0.95), ("lo", "hi"))
    return {r["dt"]: (r["lo"], r["hi"]) for r in found.collect()}


def test_percentiles_match_numpy(spark):
    rng = random.Random(7)
    groups = {
        "plain": [rng.gauss(10, 4) for _ in range(501)],
        "few": [1.0, 2.0, 3.0, 10.0, None],
        "single": [4.0],
        "constant": [3.0] * 50,
        "repeats": [float(rng.randint(0, 5)) for _ in range(400)],
        "outlier": [rng.random() for _ in range(300)] + [1e12, -1e12],
        "infinite": [1.0, 2.0, float("inf"), float("-inf"), 5.0],
        "negative": [-float(i) for i in range(37)],
    }
    found = percentiles(spark, {**groups, "empty": [None, None]})
    assert "empty" not in found
    for name, values in groups.items():
        kept = [v for v in values if v is not None and np.isfinite(v)]
        assert found[name] == pytest.approx(tuple(np.percentile(kept, [5, 95])), rel=1e-9, abs=1e-9), name


def test_percentiles_of_any_scope(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"), F.col("id").cast("double").alias("v"))
    found = scope_percentiles(df, F.col("v"), ["a", "b"], (0.5,), ("mid",))
    for r in found.collect():
        values = [i for i in range(1000) if i % 3 == r["a"] and i % 2 == r["b"]]
        assert r["mid"] == pytest.approx(np.median(values))


def test_percentile_scale_edges(spark):
    df = spark.createDataFrame(
        [(5.0, None, None), (3.0, 3.0, 3.0), (4.0, 3.0, 3.0), (None, 3.0, 3.0), (None, 1.0, 2.0), (9.0, 1.0, 2.0)],
        "v double, lo double, hi double",
    )
    got = [r[0] for r in df.select(percentile_scale(F.col("v"), F.col("lo"), F.col("hi"))).collect()]
    assert got == [0.0, 0.0, 1.0, 0.0, None, 1.0]


# ---- series ----------------------------------------------------------------


def brute_force(points, target, edges):
    known = sorted((t, v) for t, v in points if v is not None)
    if not known:
        return None
    before = [p for p in known if p[0] <= target]
    after = [p for p in known if p[0] >= target]
    if before and after:
        (t0, v0), (t1, v1) = before[-1], after[0]
        return v0 if t0 == t1 else v0 + (v1 - v0) * ((target - t0) / (t1 - t0))
    if edges == "inside":
        return None
    return before[-1][1] if before else after[0][1]


@pytest.mark.parametrize("edges", ["clamp", "inside"])
def test_interpolation_matches_brute_force(spark, edges):
    rng = random.Random(3)
    points, targets = {}, {}
    for s in range(6):
        minutes = rng.sample(range(0, 6 * 1440), rng.choice([0, 1, 2, 25]))
        points[s] = [
            (START + dt.timedelta(minutes=m), rng.choice([None, rng.random()]), rng.random()) for m in minutes
        ]
        targets[s] = [START + dt.timedelta(minutes=rng.randrange(-2000, 9 * 1440)) for _ in range(40)]
        targets[s] += [p[0] for p in points[s]][:5]
        targets[s] = sorted(set(targets[s]))
    p = spark.createDataFrame([(s, *r) for s, rs in points.items() for r in rs], "s int, time timestamp_ntz, a double, b double")
    t = spark.createDataFrame([(s, r) for s, rs in targets.items() for r in rs], "s int, time timestamp_ntz")
    got = {(r["s"], r["time"]): (r["a"], r["b"]) for r in series.interpolate(p, t, ["s"], ["a", "b"], edges=edges).collect()}
    assert len(got) == sum(map(len, targets.values()))
    for (s, time), values in got.items():
        for i, v in enumerate(values, start=1):
            want = brute_force([(q[0], q[i]) for q in points[s]], time, edges)
            assert v == (None if want is None else pytest.approx(want)), (s, time, i)


def test_interpolation_worked_example(spark):
    p = spark.createDataFrame([(START + dt.timedelta(hours=h), float(v)) for h, v in ((3, 1), (4, 2), (5, 3))], "time timestamp_ntz, v double")
    t = spark.createDataFrame([(START + dt.timedelta(hours=h),) for h in range(9)], "time timestamp_ntz")
    got = [r["v"] for r in series.interpolate(p, t, [], ["v"]).orderBy("time").collect()]
    assert got == [1, 1, 1, 1, 2, 3, 3, 3, 3]


def test_resample_starts_at_the_first_point(spark):
    p = spark.createDataFrame(
        [("a", START + dt.timedelta(minutes=20), 0.0), ("a", START + dt.timedelta(minutes=170), 5.0), ("b", START, 9.0)],
        "s string, time timestamp_ntz, v double",
    )
    got = rows(series.resample_hourly(p, ["s"], ["v"]))
    assert [(r[0], r[1].strftime("%H:%M"), round(r[2], 6)) for r in got] == [
        ("a", "00:20", 0.0), ("a", "01:20", 2.0), ("a", "02:20", 4.0), ("b", "00:00", 9.0),
    ]


# ---- slots and as-of -------------------------------------------------------


def test_target_slots_start_no_earlier_than_now(spark):
    polls = spark.createDataFrame([(START.replace(hour=7, minute=40),)], "now timestamp_ntz")
    based = slots.poll_bases(polls)
    assert based.first()["baseTime"] == "0500"
    assert [r["fcstTime"] for r in slots.target_slots(based).collect()] == [f"{h:02d}00" for h in range(7, 13)]
    assert [r["fcstTime"] for r in slots.target_slots(based, now=None).collect()] == [f"{h:02d}00" for h in range(6, 12)]


def test_fallback_slots_only_for_cells_without_a_hit(spark):
    items = spark.createDataFrame(
        [(1, 1, "20250801", "0700"), (1, 1, "20250801", "0600"), (2, 1, "20250801", "0600"), (3, 1, "20250801", "2300")],
        "nx int, ny int, fcstDate string, fcstTime string",
    )
    primary = spark.createDataFrame([("20250801", "0700")], "fcstDate string, fcstTime string")
    other = spark.createDataFrame([("20250801", "0600")], "fcstDate string, fcstTime string")
    assert rows(slots.keep_slots_or_fallback(items, primary, other)) == [
        (1, 1, "20250801", "0700"), (2, 1, "20250801", "0600"),
    ]


def test_hours_of_feeds(spark):
    feed = spark.createDataFrame(
        [("20250801", "0030"), ("20250801", "0130"), ("20250801", "130"), ("20250801", "9900"), ("19990801", "0000")],
        "fcstDate string, fcstTime string",
    )
    hours = slots.all_forecast_hours([feed, feed])
    assert hours.count() == 2
    assert [r["ts"].hour for r in slots.newest_hours(hours, 1).collect()] == [1]
    now = F.lit("2025-08-02 10:20:00").cast("timestamp_ntz")
    assert sorted(r["ts"].hour for r in slots.last_hours(hours, now, 3).collect()) == [0, 1, 23]
    nothing = hours.limit(0)
    assert [r["ts"].hour for r in slots.newest_hours(nothing, 6, now).collect()] == [10]
    assert sorted(r["ts"].hour for r in slots.last_hours(nothing, now, 2).collect()) == [9, 10]
    assert slots.hours_or_last(nothing, now).count() == 6
    assert slots.hours_or_last(hours, now).count() == 2


def test_latest_base_looks_back_a_few_hours_only(spark):
    items = spark.createDataFrame(
        [(1, 1, "20250801", "0900", "a"), (1, 1, "20250801", "0800", "b"), (2, 1, "20250801", "0600", "c"),
         (3, 1, "20250801", "0500", "d"), (4, 1, "20250801", "0930", "e")],
        "nx int, ny int, baseDate string, baseTime string, v string",
    )
    now = F.lit("2025-08-01 09:50:00").cast("timestamp_ntz")
    assert [r[-2] for r in rows(asof.latest_base(items, clock.nowcast_base(now)))] == ["a", "c"]
    assert [r[-2] for r in rows(asof.latest_base(items, clock.forecast_base(now)))] == ["e"]


# ---- storm -----------------------------------------------------------------


def test_track_names_and_bad_rows(spark):
    items = spark.createDataFrame(
        [("202508010000", None, "20", 130.0, "12"), (None, "2025-08-01 06:00:00", "21", 131.0, None),
         ("189901010000", None, "21", 131.0, None), ("bad", None, "21", 131.0, None), ("202508010300", None, "x", 131.0, None)],
        "typTm string, tm string, typLat string, lon double, ws string",
    )
    track = storm.clean_track(items)
    assert [(r.time.hour, r.lat, r.lon, r.wind) for r in track.orderBy("time").collect()] == [
        (0, 20.0, 130.0, 12.0), (6, 21.0, 131.0, None),
    ]


def test_storm_feed_cases(spark):
    grid = spark.createDataFrame([(1, 1, 0.0, 0.0), (2, 1, 0.0, 1.0), (3, 1, None, 1.0)], "nx int, ny int, lat double, lon double")
    targets = spark.createDataFrame([(START + dt.timedelta(hours=h),) for h in (0, 1)], "ts timestamp_ntz")
    schema = "time timestamp_ntz, lat double, lon double, wind double"
    one = spark.createDataFrame([(START, 0.0, 1.0, None), (START, 0.0, 0.0, 20.0)], schema)
    got = rows(storm.build_storm_feed(grid, one, targets, ["wind"]))
    assert len(got) == 4
    assert got[0][2:4] == ("20250801", "0000")
    assert [round(r[4], 3) for r in got] == [0.0, 0.0, 111.195, 111.195]
    assert {r[5:] for r in got} == {(20.0, 0.0)}
    none = storm.build_storm_feed(grid, spark.createDataFrame([], schema), targets)
    assert {r[4:] for r in rows(none)} == {(None, None, None)}
    assert none.count() == 4
    empty = storm.build_storm_feed(None, one, targets)
    assert empty.count() == 0 and empty.schema == storm.STORM_SCHEMA


def test_latest_announcement(spark):
    items = spark.createDataFrame([("20250801", None), ("202508010300", None), (None, "202508010600")], "tmFc string, announceTime string")
    assert storm.latest_announcement(items).first()["tmFc"] == "202508010600"


# ---- UV --------------------------------------------------------------------


def test_uv_feed(spark):
    base = START.replace(hour=9)
    items = spark.createDataFrame(
        [
            ("A", base, 1, {"h0": "1", "h3": "7"}),
            ("A", base, 2, {"h3": "4"}),  # the later item wins
            ("A", base - dt.timedelta(hours=3), 3, {"h0": "9"}),  # an older base
            ("A", base + dt.timedelta(hours=3), 4, {"h0": "9"}),  # after the anchor
            ("B", base - dt.timedelta(hours=40), 5, {"uvIndex": "6.5"}),
            ("C", base - dt.timedelta(hours=60), 6, {"h0": "6"}),  # too old
            ("D", base, 7, {"h0": "", "code": "A07"}),  # no value at all
        ],
        "admin_code string, base_ts timestamp_ntz, seq int, item map<string,string>",
    )
    calls = spark.createDataFrame([("A", 1, 1), ("A", 2, 1), ("B", 3, 1), ("C", 4, 1), ("D", 5, 1)], "admin_code string, nx int, ny int")
    targets = spark.createDataFrame([(START.replace(hour=h),) for h in (9, 10, 11, 12, 21)], "ts timestamp_ntz")
    got = rows(uv.build_uv_feed(items, calls, targets))
    assert {(r[0], r[1]) for r in got} == {(1, 1), (2, 1), (3, 1)}
    assert [(r[3], r[4]) for r in got if r[0] == 1] == [("0900", 1), ("1000", 2), ("1100", 3), ("1200", 4), ("2100", 0)]
    assert {r[4] for r in got if r[0] == 3} == {6, 0}  # halves go to the even neighbour


# ---- wide feeds and regions ------------------------------------------------


def test_short_forecast_wide(spark):
    item = "nx int, ny int, fcstDate string, fcstTime string, category string, fcstValue string"
    key = (1, 1, "20250801", "0300")
    items = spark.createDataFrame(
        [(*key, "TMP", "20"), (*key, "TMP", "23"), (*key, "PCP", "1mm 미만"), (*key, "SKY", "3"), (*key, "SKY", "4"),
         (*key, "VEC", "180"), (2, 1, "20250801", "0300", "TMP", "bad"), (3, 1, None, "0300", "TMP", "1")],
        item,
    )
    got = wide.short_forecast_wide(items)
    assert got.columns == ["nx", "ny", "fcstDate", "fcstTime", "valid_ts_kst", "PCP", "POP", "PTY", "REH", "SKY", "TMP", "WSD"]
    row = got.collect()
    assert len(row) == 1
    assert (row[0].TMP, row[0].PCP, row[0].SKY, row[0].POP) == (21.5, 0.5, 3, None)
    assert wide.short_forecast_wide(items, ("TMP", "VEC")).columns[-1] == "TMP"


def test_latest_wide_keeps_the_last_known_value(spark):
    items = spark.createDataFrame(
        [(1, 1, "20250801", "0300", "T1H", "20", 1), (1, 1, "20250801", "0300", "T1H", "21", 2), (1, 1, "20250801", "0300", "T1H", None, 3),
         (2, 1, "20250801", "0300", "T1H", None, 1)],
        "nx int, ny int, baseDate string, baseTime string, category string, obsrValue string, seq int",
    )
    assert rows(wide.latest_wide(items, ("T1H", "RN1"))) == [("20250801", "0300", 1, 1, "21", None)]


def test_region_labels_and_attach(spark):
    table = spark.createDataFrame(
        [("1", "1", "b"), ("1", "1", "a"), ("1", "1", "a"), ("2", "1", None)], "nx string, ny string, admin_name string"
    )
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "nx int, ny int")
    assert rows(regions.attach_regions(df, table)) == [(1, 1, "a|b"), (2, 1, None), (3, 1, None)]
    assert rows(regions.attach_regions(df, None))[0] == (1, 1, None)
    assert rows(regions.attach_regions(df, table.drop("admin_name")))[0] == (1, 1, None)


def test_region_dimension_and_short_codes(spark):
    points = spark.createDataFrame(
        [("1111010100", "a", 37.5665, 126.9780), ("1111010100", "b", 33.5, 126.5), ("26110", "c", 35.1796, 129.0756)],
        "admin_code string, admin_name string, lat double, lon double",
    )
    got = {r.admin_code: r for r in regions.region_dimension(points).collect()}
    assert (got["1111010100"].nx, got["1111010100"].ny, got["1111010100"].SIG_CD) == (60, 127, "11110")
    assert got["26110"].SIG_CD == "26110"
    short = regions.region_dimension(points.withColumn("admin_code", F.substring("admin_code", 1, 3)))
    assert {r.SIG_CD for r in short.collect()} == {None}


def test_region_map_and_call_list_checks(spark):
    df = spark.createDataFrame([("1", "2", " a "), ("1", "2", "a"), ("x", "2", "a")], "NX string, NY string, adm_name string")
    assert rows(regions.clean_region_map(df)) == sorted([(1, 2, "a"), (None, 2, "a")], key=repr)
    with pytest.raises(ValueError):
        regions.clean_region_map(df.drop("NX"))
    calls = spark.createDataFrame([(" 11 ", "1", "2"), (None, "1", "2")], "areaNo string, nx string, ny string")
    assert rows(regions.clean_calls(calls)) == [("11", 1, 2)]
    with pytest.raises(ValueError):
        regions.clean_calls(calls.drop("areaNo"))
    with pytest.raises(ValueError):
        regions.unique_grid(calls)


def test_short_forecast_with_codes(spark):
    w = spark.createDataFrame([(1, 1, "20250801", "0300", 2.0), (1, 1, "20250801", "0300", 1.0)], "nx int, ny int, fcstDate string, fcstTime string, TMP double")
    calls = spark.createDataFrame([("11", 1, 1)], "admin_code string, nx int, ny int")
    coded = wide.with_region_code(w, calls)
    assert coded.columns[0] == "admin_code"
    assert rows(wide.unique_short_forecast(coded)) == [(11, 1, 1, "20250801", "0300", 1.0)]
