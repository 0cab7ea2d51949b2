from __future__ import annotations

import json
import os

import pytest

from galecast.__main__ import main
from galecast.plans import bronze
from galecast.plans.silver import run_silver
from galecast.sources.schemas import FEEDS
from galecast.sources.tables import scan_run

RUN = "2025080516"


def response(*items, code: str = "00", message: str = "NORMAL_SERVICE") -> str:
    return json.dumps({"response": {"header": {"resultCode": code, "resultMsg": message}, "body": {"items": {"item": list(items)}}}})


def item(base: str, category: str, value: str, fcst: str | None = None, **more) -> dict:
    out = {"baseDate": "20250805", "baseTime": base, "category": category, **more}
    return out | ({"fcstDate": "20250805", "fcstTime": fcst, "fcstValue": value} if fcst else {"obsrValue": value})


UV_XML = "<response><header><resultCode>00</resultCode></header><body><items><item><h0>3</h0><h3>6</h3></item></items></body></response>"
QUOTA = "<r><cmmMsgHeader><returnAuthMsg>LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR</returnAuthMsg></cmmMsgHeader></r>"
FILES = {
    "service=ultra_nowcast/dt=2025080516/nx=60/ny=127/a.json": response(item("1500", "T1H", "30"), item("1500", "REH", "70")),
    "service=ultra_nowcast/dt=2025080516/nx=60/ny=127/old.json": response(item("1400", "T1H", "10")),
    "service=ultra_nowcast/dt=2025080516/nx=61/ny=127/future.json": response(item("1600", "T1H", "99")),
    "service=ultra_shortfcst/dt=2025080516/nx=60/ny=127/a.json": response(*[item("1530", c, v, f"{h}00") for h in (16, 17, 18) for c, v in (("T1H", "31"), ("WSD", "4"))]),
    "service=short_fcst/dt=2025080516/nx=60/ny=127/a.json": response(item("1400", "POP", "60", "1500"), item("1400", "POP", "40", "1700"), item("1400", "PCP", "1mm 미만", "1700")),
    "service=short_fcst/dt=2025080516/nx=61/ny=127/a.json": response(item("1400", "POP", "20", "1500")),
    "service=uv/dt=2025080516/area=1100/asked=2025080515/a.xml": UV_XML,
    "service=uv/dt=2025080516/area=1200/asked=2025080515/a.xml": QUOTA,
    "service=typhoon/dt=2025080516/a.json": response({"typTm": "202508051500", "lat": 30.0, "lon": 126.0, "ws": 35}, {"typTm": "202508052000", "lat": 31.0, "lon": 126.0, "ws": 40}),
    "service=short_fcst/dt=2025080516/nx=62/ny=127/no.json": response(code="03", message="NO_DATA"),
    "service=short_fcst/dt=2025080516/nx=63/ny=127/bad.json": "<html>busy</html>",
    "service=elsewhere/dt=2025080516/x.json": response(item("1400", "POP", "1", "1500")),
}


def put(root, files) -> None:
    for name, text in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)


def feed(spark, root: str, name: str) -> list:
    rows = scan_run(spark, root, name, RUN).drop("valid_ts_kst")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.fixture(scope="module")
def collected(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("collect"))
    put(f"{root}/landed", FILES)
    with open(f"{root}/calls.csv", "w") as f:
        f.write("areaNo,nx,ny\n1100,60,127\n1300,61,127\n")
    spark.createDataFrame([(60, 127, 37.5, 127.0), (61, 127, 37.5, 127.1)], "nx int, ny int, lat double, lon double").write.parquet(f"{root}/grid.parquet")
    job(root)
    return root


def job(root: str) -> None:
    main([
        "collect", "--landed", f"{root}/landed", "--bronze", f"{root}/bronze", "--calls", f"{root}/calls.csv",
        "--grid", f"{root}/grid.parquet", "--progress", f"{root}/progress",
    ])


def test_every_response_is_in_one_part(spark, collected):
    rows = bronze.read_landed(spark, f"{collected}/bronze")
    counts = {(r.service, r.part, r.status): r["count"] for r in rows.dropDuplicates(["service", "seq", "nx", "area", "part"]).groupBy("service", "part", "status").count().collect()}
    assert sum(counts.values()) == len(FILES)
    assert counts[("uv", "quarantine", "quota")] == counts[("short_fcst", "quarantine", "not_json")] == counts[("short_fcst", "no_data", "no_data")] == 1
    assert counts[("elsewhere", "quarantine", "good")] == 1
    refused = {(r.service, r.text) for r in bronze.quarantined(spark, f"{collected}/bronze").collect()}
    assert ("short_fcst", "<html>busy</html>") in refused and ("uv", QUOTA) in refused


def test_feeds_of_a_run(spark, collected):
    root = f"{collected}/bronze"
    nowcast = scan_run(spark, root, "ultra_nowcast", RUN).select("nx", "ny", "baseTime", "T1H", "REH").collect()
    assert [tuple(r) for r in nowcast] == [(60, 127, "1500", "30", "70")]  # not the older base, not one to come
    ultra = scan_run(spark, root, "ultra_shortfcst", RUN).select("fcstTime", "T1H", "WSD").collect()
    assert sorted(tuple(r) for r in ultra) == [("1600", "31", "4"), ("1700", "31", "4"), ("1800", "31", "4")]
    short = scan_run(spark, root, "short_fcst", RUN).select("admin_code", "nx", "fcstTime", "POP", "PCP").collect()
    assert sorted(tuple(r) for r in short) == [(1100, 60, "1700", 40.0, 0.5), (1300, 61, "1500", 20.0, None)]  # the second by fallback
    uv = scan_run(spark, root, "uv", RUN).select("nx", "fcstTime", "UVI").collect()
    assert sorted(tuple(r) for r in uv) == [(60, "1600", 4), (60, "1700", 5), (60, "1800", 6)]
    storm = scan_run(spark, root, "typhoon", RUN).collect()
    assert len(storm) == 12 and {r.fcstTime for r in storm} == {f"{h}00" for h in range(13, 19)}
    assert all(r.TY_WARNING == 0.0 and 600 < r.TY_DISTANCE_KM < 900 for r in storm)
    run_silver(spark, root, f"{collected}/silver", None, RUN)
    rows = spark.read.parquet(f"{collected}/silver").collect()
    assert len(rows) == 3 and {(r.UVI, r.POP) for r in rows} == {(4, None), (5, 40.0), (6, None)} and all(r.TY_MAX_WIND is not None for r in rows)


def test_replay_replaces_and_later_responses_add(spark, collected):
    root = f"{collected}/bronze"
    before = {name: feed(spark, root, name) for name in FEEDS}
    calls = spark.createDataFrame([("1100", 60, 127), ("1300", 61, 127)], "admin_code string, nx int, ny int")
    grid = spark.read.parquet(f"{collected}/grid.parquet")
    again = bronze.read_landed(spark, root)
    n = again.count()
    stored = bronze.landed_responses(spark, f"{collected}/landed")
    query = bronze.collect(stored, root, f"{collected}/other_progress", calls, grid)  # the same batch number once more
    query.awaitTermination()
    assert bronze.read_landed(spark, root).count() == n
    assert {name: feed(spark, root, name) for name in FEEDS} == before
    put(f"{collected}/landed", {"service=ultra_nowcast/dt=2025080516/nx=62/ny=127/late.json": response(item("1500", "T1H", "21", nx=62, ny=127))})
    job(collected)
    assert {r.nx for r in scan_run(spark, root, "ultra_nowcast", RUN).collect()} == {60, 62}
    assert feed(spark, root, "uv") == before["uv"]


def test_storm_feed_without_a_grid_is_typed_and_empty(spark, tmp_path):
    rows = spark.createDataFrame([], bronze.STORED)
    hours = spark.createDataFrame([], "dt string, ts timestamp_ntz")
    empty = bronze.track_feed(rows, None, hours)
    assert empty.count() == 0 and set(FEEDS["typhoon"].fieldNames()) <= set(empty.columns)
