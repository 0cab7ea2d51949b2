"""Worked values of every expression."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from galecast.functions import clock, geo, precip
from galecast.functions import scores as S
from galecast.functions.numeric import clip, number_from_text, pick_number


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def d(value):
    return F.lit(value).cast("double")


# (text, range dialect, search dialect, collector dialect)
AMOUNTS = [
    (None, 0.0, 0.0, None),
    ("", 0.0, 0.0, None),
    ("-", 0.0, 0.0, None),
    ("강수없음", 0.0, 0.0, 0.0),
    ("적설없음", 0.0, 0.0, 0.0),
    ("5.0mm", 5.0, 5.0, 5.0),
    ("5.0", 5.0, 5.0, 5.0),
    ("1mm 미만", 0.5, 0.5, 0.5),
    ("1.0mm미만", 0.5, 1.0, 0.5),
    ("0.1mm 미만", 0.05, 0.5, 0.1),
    ("10~20mm", 15.0, 20.0, None),
    ("30.0~50.0mm", 40.0, 50.0, None),
    ("50mm 이상", 50.0, 50.0, None),
    ("10-20mm", 0.0, 0.0, None),
    ("<1mm", 0.0, 0.5, None),
    ("-3", 0.0, 0.0, -3.0),
    ("5.0㎜", 5.0, 0.0, None),
]


def test_amount_dialects(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(AMOUNTS)], "i int, t string")
    rows = df.select(
        "i",
        precip.mm_range(F.col("t")).alias("r"),
        precip.mm_search(F.col("t")).alias("s"),
        precip.mm_collector(F.col("t")).alias("c"),
    ).collect()
    for row in rows:
        text, in_range, search, collector = AMOUNTS[row["i"]]
        assert row["r"] == pytest.approx(in_range), text
        assert row["s"] == pytest.approx(search), text
        assert row["c"] == (None if collector is None else pytest.approx(collector)), text


@pytest.mark.parametrize(
    "text,value",
    [("1.5", 1.5), (" -2 ", -2.0), ("1e3", 1000.0), ("1.5d", None), ("강수없음", None), ("", None), (None, None)],
)
def test_number_from_text(spark, text, value):
    assert one(spark, number_from_text(F.lit(text).cast("string"))) == value


@pytest.mark.parametrize(
    "rate,chance,amount,expected",
    [(0, 0, 0, 0.010000), (0, 80, 10, 0.010000), (0.2, 100, 50, 0.020926), (5, 60, 5, 0.119165),
     (30, 90, 30, 0.683926), (80, 100, 80, 0.970000)],
)
def test_rain(spark, rate, chance, amount, expected):
    assert one(spark, S.rain_score(d(rate), d(amount), d(chance))) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize(
    "t,h,w,expected",
    [(None, None, None, 0.24), (10, 50, 0, 0.12), (23, 95, 0, 0.237619), (33, 80, 2, 0.704806),
     (36, 90, 8, 0.841022), (45, 60, 0, 0.96)],
)
def test_heat(spark, t, h, w, expected):
    assert one(spark, S.heat_score(d(t), d(h), d(w))) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("speed,expected", [(None, 0), (0, 0), (2, 0.01), (10, 0.3), (25, 0.9375), (40, 1.0)])
def test_wind(spark, speed, expected):
    assert one(spark, S.wind_score(d(speed))) == pytest.approx(expected, abs=1e-9)


def test_wind_vector(spark):
    assert one(spark, S.wind_score(S.wind_speed(d(None), d(3), d(4)))) == pytest.approx(0.0525)
    assert one(spark, S.wind_score(S.wind_speed(d(12), d(None), d(4)))) == pytest.approx(0.45)


@pytest.mark.parametrize("index,expected", [(None, 0.0), (0, 0.119203), (3, 0.320821), (6, 0.622459), (12, 0.952574), (15, 0.952574)])
def test_uv(spark, index, expected):
    assert one(spark, S.uv_score(d(index))) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("sky,warm,day,damp,expected", [(1, 1, 1, 1, 0.924142), (3, 0.5, 0.3, 0.3, 0.127583)])
def test_uv_estimate(spark, sky, warm, day, damp, expected):
    assert one(spark, S.uv_estimate_score(d(sky), d(warm), d(day), d(damp))) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize(
    "distance,strength,warning,expected",
    [(None, 0, 0, 0.01), (0, 1, 1, 0.977931), (100, 0.5, 0, 0.801317), (700, 1, 0, 0.039748), (2000, 1, 0, 0.01)],
)
def test_storm(spark, distance, strength, warning, expected):
    assert one(spark, S.storm_score(d(distance), d(strength), d(warning))) == pytest.approx(expected, abs=1e-6)


def test_total(spark):
    parts = {"rain": d(0.683926), "heat": d(0.704806), "wind": d(0.3), "uv": d(0.622459), "typhoon": d(0.801317)}
    assert one(spark, S.total_score(parts)) == pytest.approx(0.746719, abs=1e-6)


@pytest.mark.parametrize("total,level", [(0.8, "VERY_HIGH"), (0.79, "HIGH"), (0.6, "HIGH"), (0.4, "MED"), (0.39, "LOW"), (None, "LOW")])
def test_level(spark, total, level):
    assert one(spark, S.risk_level(d(total))) == level


@pytest.mark.parametrize(
    "lat,lon,cell", [(38, 126, (43, 136)), (37.5665, 126.9780, (60, 127)), (33.5, 126.5, (52, 38)), (35.1796, 129.0756, (98, 76))]
)
def test_grid(spark, lat, lon, cell):
    nx, ny = geo.grid_cell(d(lat), d(lon))
    row = spark.range(1).select(nx.alias("nx"), ny.alias("ny")).first()
    assert (row["nx"], row["ny"]) == cell


@pytest.mark.parametrize(
    "a,b,km", [((37.5665, 126.978), (35.1796, 129.0756), 325.111259), ((0, 0), (0, 1), 111.194927)]
)
def test_distance(spark, a, b, km):
    assert one(spark, geo.distance_km(d(a[0]), d(a[1]), d(b[0]), d(b[1]))) == pytest.approx(km, abs=1e-6)


def test_clip_keeps_null(spark):
    assert one(spark, clip(d(None), 0.0, 1.0)) is None
    assert one(spark, clip(d(7), 0.0, 1.0)) == 1.0


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "now,issue",
    [
        ("2025-08-01 02:24:59", dt.datetime(2025, 7, 31, 23)),
        ("2025-08-01 02:25:00", dt.datetime(2025, 8, 1, 2)),
        ("2025-08-01 01:59:00", dt.datetime(2025, 7, 31, 23)),
        ("2025-08-01 05:10:00", dt.datetime(2025, 8, 1, 2)),
        ("2025-08-01 23:40:00", dt.datetime(2025, 8, 1, 23)),
    ],
)
def test_issue_time(spark, now, issue):
    assert one(spark, clock.issue_time(ts(now))) == issue


@pytest.mark.parametrize(
    "now,nowcast,forecast",
    [
        ("2025-08-01 00:09:59", dt.datetime(2025, 7, 31, 23), dt.datetime(2025, 7, 31, 23, 30)),
        ("2025-08-01 00:10:00", dt.datetime(2025, 8, 1, 0), dt.datetime(2025, 7, 31, 23, 30)),
        ("2025-08-01 00:45:00", dt.datetime(2025, 8, 1, 0), dt.datetime(2025, 8, 1, 0, 30)),
    ],
)
def test_base_candidates(spark, now, nowcast, forecast):
    assert one(spark, clock.nowcast_base(ts(now))) == nowcast
    assert one(spark, clock.forecast_base(ts(now))) == forecast


@pytest.mark.parametrize(
    "date,time,expected",
    [
        ("20250801", "0300", dt.datetime(2025, 8, 1, 3)),
        ("20250832", "0300", None),
        ("20250801", "2500", None),
        ("2025-8-1", "0300", None),
        ("20250801", None, None),
    ],
)
def test_forecast_clock(spark, date, time, expected):
    assert one(spark, clock.forecast_clock(F.lit(date), F.lit(time).cast("string"))) == expected


def test_zoned_instant_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            seconds = one(spark, F.unix_seconds(clock.zoned_instant(ts("2025-08-01 09:00:00"))))
            assert seconds == 1754006400  # midnight UTC
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_now_clock_is_local_time(spark):
    apart = one(spark, clock.epoch_seconds(clock.now_clock()) - F.unix_seconds(F.current_timestamp()))
    assert apart == pytest.approx(9 * 3600, abs=5)


def test_pick_number_takes_the_row_maximum_of_variants(spark):
    df = spark.createDataFrame(
        [(1.0, "3.5", None), (None, None, float("nan")), (float("nan"), "x", 2.0)],
        "WSD double, WSD_nc string, WSD_vil double",
    )
    assert [r[0] for r in df.select(pick_number(df, ["WSD"])).collect()] == [3.5, None, 2.0]
    assert df.select(pick_number(df, ["POP"])).first()[0] is None
