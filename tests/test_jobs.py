"""Sources, sinks, whole jobs and streams on small tables."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galecast.__main__ import main
from galecast.functions import scores as S
from galecast.operators import scoring
from galecast.plans import alerts, features, gold, silver
from galecast.sources import responses, tables
from galecast.sources.schemas import FEEDS, ITEM, REGIONS, TRACK_ITEM
from galecast.streaming import daily as stream_daily
from galecast.streaming import dedupe as stream_dedupe
from galecast.streaming import ingest as stream_ingest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def envelope(items, code="00", message="NORMAL_SERVICE"):
    body = {"items": {"item": items} if items is not None else ""}
    return json.dumps({"response": {"header": {"resultCode": code, "resultMsg": message}, "body": body}}, ensure_ascii=False)


ONE = {"category": "T1H", "fcstValue": 21, "baseDate": "20250801", "baseTime": "0530", "fcstDate": "20250801", "fcstTime": "0600"}
TWO = {**ONE, "category": "RN1", "fcstValue": "강수없음", "nx": 60, "ny": 127}
XML = "<response><header><resultCode>00</resultCode></header><body><items>{}</items></body></response>"


def landed(spark, tmp_path):
    texts = {
        "nx=1/ny=2/a": envelope([ONE, TWO]),
        "nx=3/ny=4/b": envelope(ONE),
        "nx=5/ny=6/c": envelope(None),
        "nx=7/ny=8/d": envelope(None, "03", "NO_DATA"),
        "nx=7/ny=9/e": envelope(None, "22", "LIMIT"),
        "nx=7/ny=7/f": "<html>\nbusy</html>",
    }
    for name, text in texts.items():
        path = tmp_path / "landed" / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(tmp_path / "landed")


# ---- responses -------------------------------------------------------------


def test_responses_become_items(spark, tmp_path):
    path = landed(spark, tmp_path)
    triaged = responses.triage(responses.read_responses(spark, f"{path}/*/*"))
    assert sorted(r.status for r in triaged.collect()) == ["error", "good", "good", "no_data", "not_json", "unreadable"]
    assert responses.quarantine(triaged).count() == 3
    items = responses.explode_items(triaged, keep=("file",))
    nx, ny = responses.request_cell(F.col("file"))
    got = rows(responses.fill_cells(items, nx, ny).select("pos", "nx", "ny", "category", "fcstValue"))
    assert got == [(0, 1, 2, "T1H", "21"), (0, 3, 4, "T1H", "21"), (1, 60, 127, "RN1", "강수없음")]


def test_other_item_schemas(spark):
    text = spark.createDataFrame([(envelope([{"typLat": 20.5, "typWs": "30"}], code="99"),)], "text string")
    items = responses.explode_items(responses.triage(text), TRACK_ITEM, only_good=False)
    assert (items.first()["typLat"], items.first()["typWs"], items.first()["lat"]) == ("20.5", "30", None)


def test_index_items_from_json_xml_and_quota(spark):
    quota = "<OpenAPI_ServiceResponse><cmmMsgHeader><returnAuthMsg>LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR</returnAuthMsg></cmmMsgHeader></OpenAPI_ServiceResponse>"
    data = [
        (1, envelope([{"h0": "1", "h3": 2}, {"h6": "3"}])), (2, envelope({"h0": "4"})),
        (3, XML.format("<item><h0>5</h0></item><item><h3>6</h3></item>")), (4, quota), (5, "nonsense"), (6, envelope(None)),
    ]
    got = rows(responses.index_items(spark.createDataFrame(data, "id int, text string"), keep=("id",)))
    assert got == [
        (1, "good", 0, {"h0": "1", "h3": "2"}), (1, "good", 1, {"h6": "3"}), (2, "good", 0, {"h0": "4"}),
        (3, "good", 0, {"h0": "5"}), (3, "good", 1, {"h3": "6"}), (4, "quota", None, None), (5, "empty", None, None),
        (6, "empty", None, None),
    ]


# ---- tables ----------------------------------------------------------------


KEY = "nx int, ny int, fcstDate string, fcstTime string"


def feed(spark, name, data, columns):
    """A feed under its declared schema; what is not given is null."""
    given = spark.createDataFrame(data, columns)
    return given.select(
        *[(F.col(f.name).cast(f.dataType) if f.name in given.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in FEEDS[name].fields]
    )


def some_feeds(spark):
    base = feed(
        spark, "ultra_shortfcst",
        [(1, 1, "20250801", "0300", "20250801", "0130", "24", "0", "3"), (1, 1, "20250801", "0300", "20250801", "0230", "33", "강수없음", None),
         (2, 1, "20250801", "0300", "20250801", "0230", "36", "40", "20")],
        f"{KEY}, baseDate string, baseTime string, T1H string, RN1 string, WSD string",
    )
    short = feed(spark, "short_fcst", [(1, 1, "20250801", "0300", 5.0, 60.0, 12.0)], f"{KEY}, PCP double, POP double, WSD double")
    return {"ultra_shortfcst": base, "ultra_nowcast": None, "short_fcst": short, "typhoon": None, "uv": None}


def test_scan_and_land(spark, tmp_path):
    root = str(tmp_path / "bronze")
    with pytest.raises(FileNotFoundError):
        tables.scan_feeds(spark, root, "2025080103")
    for run in ("2025080103", "2025080104", "2025080103"):  # a rerun replaces its own run only
        assert tables.land_feeds(some_feeds(spark), root, run) == ["ultra_shortfcst", "short_fcst"]
    found = tables.scan_feeds(spark, root, "2025080103")
    assert found["uv"] is None and found["short_fcst"].count() == 1
    assert found["ultra_shortfcst"].count() == 3
    assert {r["dt"] for r in found["ultra_shortfcst"].collect()} == {"2025080103"}
    both = tables.scan_run(spark, root, "ultra_shortfcst", ["2025080103", "2025080104"])
    assert both.count() == 6
    assert "dt" in both._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert tables.scan_run(spark, root, "ultra_shortfcst", "2025080199") is None


def test_only_an_absent_path_is_optional(spark, tmp_path):
    with pytest.raises(Exception, match="no_such_format"):
        tables.scan_run(spark, str(tmp_path), "uv", "2025080103", table_format="no_such_format")


def test_read_dimension_csv(spark, tmp_path):
    path = tmp_path / "regions.csv"
    path.write_text("﻿admin_code,admin_name,nx,ny,lat,lon\n0111,가,60,127,37.5,127.0\n", encoding="utf-8")
    row = tables.read_dimension(spark, str(path), REGIONS).first()
    assert (row.admin_code, row.nx, row.lat, row.SIG_CD) == ("0111", 60, 37.5, None)
    assert tables.read_dimension(spark, str(path)).columns[0] == "admin_code"


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = tables.shared_folder(spark, "x")
    assert root is None or folder.startswith(root)
    assert folder != tables.shared_folder(spark, "x")


# ---- scores ----------------------------------------------------------------


def test_scores_do_not_depend_on_partitions_or_order(spark):
    df = spark.range(400).select(
        (F.col("id") % 2).cast("string").alias("dt"), "id", ((F.col("id") * 7) % 40).cast("double").alias("T1H"),
        F.lit("1300").alias("fcstTime"), ((F.col("id") * 11) % 50).cast("double").alias("TY_MAX_WIND"),
        ((F.col("id") * 13) % 900).cast("double").alias("TY_DISTANCE_KM"),
    )
    columns = ["id", *[f"R_{h}" for h in scoring.HAZARDS], "R_total"]
    first = {r["id"]: r for r in scoring.score_all(df.repartition(1)).select(columns).collect()}
    second = {r["id"]: r for r in scoring.score_all(df.repartition(7, "T1H").orderBy(F.desc("id"))).select(columns).collect()}
    assert first == second
    for r in first.values():
        parts = [r[f"R_{h}"] for h in scoring.HAZARDS]
        assert all(0 <= p <= 1 for p in parts)
        assert 0.7 * max(parts) - 1e-12 <= r["R_total"] <= 1


def test_missing_columns(spark):
    df = spark.createDataFrame([("r", 1.0)], "dt string, other double")
    df = df.withColumn("fcstTime", F.lit("1200"))
    row = scoring.score_all(df).first()
    assert row.R_typhoon == 0.0 and row.R_wind == 0.0
    assert row.R_rain == pytest.approx(0.01) and row.R_heat == pytest.approx(0.24)
    with_storm = scoring.score_all(df.withColumn("TY_WARNING", F.lit(None).cast("double"))).first()
    assert with_storm.R_typhoon == pytest.approx(0.01)
    null_index = scoring.score_all(df.withColumn("UVI", F.lit(None).cast("double"))).first()
    assert null_index.R_uv == 0.0


def test_temperature_falls_back_by_run(spark):
    df = spark.createDataFrame([("a", None, 40.0), ("b", 20.0, 40.0), ("b", None, 40.0)], "dt string, T1H double, TMP double")
    got = rows(scoring.add_scores(df, {"heat": scoring.HAZARDS["heat"]}).select("dt", "T1H", "R_heat"))
    # Run a has no T1H and takes TMP (40); a null in run b takes the usual 24.
    assert [(g[0], round(g[2], 3)) for g in got] == [("a", 0.96), ("b", 0.16), ("b", 0.24)]


def test_a_hazard_of_ones_own(spark):
    df = spark.createDataFrame([("r", 0.9)], "dt string, smoke double")
    own = {"smoke": scoring.Hazard(lambda c: c["level"], lambda d: {"level": F.col("smoke")})}
    row = scoring.score_all(df, own, {"smoke": 1.0}).first()
    assert (row.R_smoke, row.R_total) == (0.9, pytest.approx(0.9))


def test_score_plan_stays_in_the_jvm(spark):
    df = spark.range(10).select(
        F.col("id").cast("string").alias("dt"), F.col("id").cast("double").alias("TY_MAX_WIND"), F.lit("0300").alias("fcstTime")
    )
    for scope in (["dt"], []):
        plan = scoring.score_all(df, scope=scope)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan


def test_scoring_without_scope_equals_one_run(spark):
    df = spark.range(90).select(
        F.lit("r").alias("dt"), "id", F.lit("1000").alias("fcstTime"), (F.col("id") * 0.4).alias("T1H"),
        (F.col("id") % 17).cast("double").alias("TY_MAX_WIND"), (F.col("id") * 9.0).alias("TY_DISTANCE_KM"),
    )
    assert rows(scoring.score_all(df, scope=[])) == rows(scoring.score_all(df))
    none = df.withColumn("TY_MAX_WIND", F.lit(None).cast("double"))
    assert rows(scoring.score_all(none, scope=[])) == rows(scoring.score_all(none))


# ---- silver and gold -------------------------------------------------------


def region_table(spark):
    return spark.createDataFrame(
        [("11110", "가", 37.5, 127.0, 1, 1), ("11140", "나", 37.6, 127.1, 1, 1), ("26110", "다", 35.1, 129.0, 2, 1)],
        "admin_code string, admin_name string, lat double, lon double, nx int, ny int",
    )


def test_silver_rows(spark):
    got = silver.build_silver(some_feeds(spark), region_table(spark), "2025080103")
    found = {r.nx: r for r in got.collect()}
    assert len(found) == 2
    assert (found[1].T1H, found[1].WSD, found[1].RN1, found[1].PCP) == (33.0, 12.0, None, 5.0)  # newest base, filled wind
    assert found[1].admin_names == "가|나" and found[2].PCP is None
    assert found[1].fcst_ts == dt.datetime(2025, 8, 1, 3) and found[1].dt == "2025080103"
    assert "UVI" not in got.columns and found[1].R_typhoon == 0.0
    text = silver.build_silver(some_feeds(spark), None, "2025080103", read_amount_text=True)
    assert {r.nx: r.RN1 for r in text.collect()} == {1: 0.0, 2: 40.0}


def test_nowcast_joins_only_with_a_valid_time(spark):
    feeds = some_feeds(spark)
    feeds["ultra_nowcast"] = feed(
        spark, "ultra_nowcast", [(1, 1, "20250801", "0300", "77")], "nx int, ny int, baseDate string, baseTime string, REH string"
    )
    skipped = {r.nx: r.REH for r in silver.merge(feeds).collect()}
    joined = {r.nx: r.REH for r in silver.merge(feeds, nowcast_valid_time="base").collect()}
    assert skipped[1] is None and joined[1] == 77.0


def silver_table(spark):
    data = [
        ("가", "20250801", "0300", "2025080103", 0.85, 1, 1), ("가", "20250801", "0600", "2025080103", 0.65, 1, 1),
        ("가", "20250801", "0600", "2025080104", 0.61, 2, 1), ("나", "20250801", "0300", "2025080103", None, 3, 1),
        ("나", "20250802", "0300", "2025080103", 0.3, 3, 1), ("나", "20250802", "0900", "2025080103", 0.3, 3, 1),
        (None, "20250801", "0300", "2025080103", 0.99, 4, 1),
    ]
    df = spark.createDataFrame(data, "admin_names string, fcstDate string, fcstTime string, dt string, R_total double, nx int, ny int")
    return df.withColumns({f"R_{h}": F.lit(0.1) for h in S.WEIGHTS})


def test_gold_latest(spark):
    got = {r.admin_names: r for r in gold.latest(silver_table(spark)).collect()}
    assert set(got) == {"가", "나"}
    assert (got["가"].dt, got["가"].R_total, got["가"].risk_level) == ("2025080104", 0.61, "HIGH")
    assert got["나"].fcst_ts == dt.datetime(2025, 8, 2, 9) and got["나"].risk_level == "LOW"
    assert gold.latest(silver_table(spark)).columns == list(gold.LATEST_COLUMNS)


def test_gold_daily(spark):
    got = rows(gold.export_daily(gold.daily(silver_table(spark))))
    first, second = dt.date(2025, 8, 1), dt.date(2025, 8, 2)
    assert got == [
        (first, "가", pytest.approx((0.85 + 0.65 + 0.61) / 3), 0.85, "0300", 3),
        (first, "나", None, None, "0300", 1),
        (second, "나", pytest.approx(0.3), 0.3, "0900", 2),
    ]


def test_alerts(spark):
    latest = gold.latest(silver_table(spark))
    lines = [r.line for r in alerts.alert_lines(latest).orderBy("part").collect()]
    assert lines == ["*🚨 기상 위험 지역 알림*", "🟠 *가*  |  위험도: `0.61` (HIGH)  |  예보: 2025-08-01 06:00:00"]
    calm = alerts.alert_lines(latest.where("R_total < 0.5"))
    assert [r.line for r in calm.collect()] == ["✅ *기상 위험 알림* | 현재 위험 지역 없음"]
    assert rows(alerts.run_summary(latest)) == [(1, 2)]
    with pytest.raises(ValueError):
        alerts.alert_rows(latest.drop("risk_level"))


def test_features(spark):
    newest = gold.newest_per_region(silver_table(spark))
    regions = region_table(spark).unionByName(spark.createDataFrame([("9", "라", None, None, 3, 1)], region_table(spark).schema))
    got = [json.loads(r.feature) for r in features.geojson_features(newest, regions).collect()]
    assert len(got) == 1
    assert got[0]["geometry"] == {"type": "Point", "coordinates": [129.0, 35.1]}
    assert got[0]["properties"]["admin_names"] == "가" and got[0]["properties"]["R_total"] == 0.61
    assert "R_wind" not in got[0]["properties"]


def test_jobs_from_the_command_line(spark, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path)
    for run in ("2025080103", "2025080104"):
        tables.land_feeds(some_feeds(spark), bronze, run)
    points = tmp_path / "points.csv"
    points.write_text("admin_code,admin_name,lat,lon\n1111010100,가,37.5665,126.978\n2611010100,나,35.1796,129.0756\n", encoding="utf-8")
    main(["dimensions", "--points", str(points), "--regions", f"{out}/regions.parquet", "--calls", f"{out}/calls", "--grid", f"{out}/grid"])
    assert rows(spark.read.parquet(f"{out}/grid").select("nx", "ny")) == [(60, 127), (98, 76)]
    regions = f"{out}/map.parquet"
    region_table(spark).write.parquet(regions)
    silver_args = ["silver", "--bronze", bronze, "--silver_out", f"{out}/silver", "--admin_map", regions, "--run_dt"]
    main([*silver_args, "2025080103"])
    main([*silver_args, "2025080104"])
    main([*silver_args, "2025080104"])
    single = spark.read.schema(spark.read.parquet(f"{out}/silver").schema).parquet(f"{out}/silver")
    assert rows(single.groupBy("dt").count()) == [(2025080103, 2), (2025080104, 2)]
    main(["silver", "--bronze", bronze, "--silver_out", f"{out}/backfill", "--admin_map", regions, "--run_dt", "2025080103", "2025080104"])
    same = ["dt", "nx", "T1H", "WSD", "PCP", "R_rain", "R_heat", "R_uv", "R_total", "admin_names"]
    assert rows(spark.read.parquet(f"{out}/backfill").select(same)) == rows(single.select(same))
    main(["latest", "--silver", f"{out}/silver", "--gold", f"{out}/latest"])
    main(["daily", "--silver", f"{out}/silver", "--gold", f"{out}/daily"])
    main(["daily", "--silver", f"{out}/silver", "--gold", f"{out}/daily", "--dates", "20250801", "20250801"])
    main(["export", "--latest", f"{out}/latest", "--daily", f"{out}/daily", "--out_latest", f"{out}/el", "--out_daily", f"{out}/ed"])
    assert spark.read.parquet(f"{out}/el").columns == list(gold.LATEST_EXPORT)
    assert spark.read.parquet(f"{out}/ed").count() == 2
    main(["alert", "--latest", f"{out}/latest", "--out", f"{out}/alert"])
    assert spark.read.text(f"{out}/alert").count() >= 1
    main(["features", "--silver", f"{out}/silver", "--admin_map", regions, "--out", f"{out}/points"])
    assert spark.read.text(f"{out}/points").count() == 3


# ---- streams ---------------------------------------------------------------


def test_ingest_stream_goes_on_where_it_stopped(spark, tmp_path):
    path = landed(spark, tmp_path)
    bronze, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")

    def run():
        stream_ingest.ingest(stream_ingest.landed_texts(spark, f"{path}/*/*"), bronze, "items", progress).awaitTermination()
        return spark.read.schema(T.StructType([T.StructField("pos", T.IntegerType()), *ITEM.fields, T.StructField("dt", T.StringType())])).parquet(f"{bronze}/items")

    first = run()
    batch = stream_ingest.items_with_run(responses.read_responses(spark, f"{path}/*/*"))
    assert rows(first.select(sorted(first.columns))) == rows(batch.select(sorted(batch.columns)))
    assert {r.dt for r in first.collect()} == {"2025080105"}
    more = tmp_path / "landed" / "nx=1" / "ny=2" / "z.json"
    more.write_text(envelope([{**ONE, "baseTime": "0630"}]), encoding="utf-8")
    assert sorted(r.dt for r in run().collect()) == ["2025080105"] * 3 + ["2025080106"]
    assert run().count() == 4


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, at timestamp"

    def run(data):
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)
        stream = stream_dedupe.drop_repeats(spark.readStream.schema(schema).parquet(source), "at", "2 days", ["k"])
        writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "progress")).option("path", table)
        writer.format("parquet").trigger(availableNow=True).start().awaitTermination()
        return sorted(r.k for r in spark.read.parquet(table).collect())

    at = dt.datetime(2025, 8, 1)
    assert run([("a", at), ("a", at)]) == ["a"]
    assert run([("a", at + dt.timedelta(hours=3)), ("b", at)]) == ["a", "b"]


def test_daily_stream_equals_the_batch(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "daily")
    rows_in = silver_table(spark).select("admin_names", "fcstDate", "fcstTime", "R_total").orderBy("fcstDate", "fcstTime", "R_total")
    everything = rows_in.collect()
    for part in (everything[:3], everything[3:5], everything[5:]):
        spark.createDataFrame(part, rows_in.schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows_in.schema).parquet(source)
        stream_daily.keep_daily(stream, table, str(tmp_path / "progress")).awaitTermination()
    got = rows(spark.read.parquet(table).select(*gold.DAILY_EXPORT))
    want = rows(gold.export_daily(gold.daily(silver_table(spark))))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert [g[2] for g in got] == [None if w[2] is None else pytest.approx(w[2]) for w in want]


def test_daily_stream_counts_rows_that_come_late(spark, tmp_path, monkeypatch):
    source, table = str(tmp_path / "in"), str(tmp_path / "daily")
    schema = "admin_names string, fcstDate string, fcstTime string, R_total double"
    batches = [
        [("A", "20250801", "0300", 0.2), ("A", "20250810", "0000", 0.5)],
        [("A", "20250801", "0400", 0.6), ("B", "20250731", "2300", None)],
        [("B", "20250820", "0000", 0.1)],
        [("A", "20250801", "0300", 0.4)],
    ]
    add = stream_daily.add_sums

    def twice(changed, number, path):  # as after a failure
        add(changed, number, path)
        add(changed, number, path)

    monkeypatch.setattr(stream_daily, "add_sums", twice)
    for batch in batches:
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        stream_daily.keep_daily(stream, table, str(tmp_path / "progress"), window="1 second", delay="0 seconds").awaitTermination()
    everything = spark.createDataFrame([r for b in batches for r in b], schema)
    assert rows(spark.read.parquet(table).select(*gold.DAILY_EXPORT)) == rows(gold.export_daily(gold.daily(everything)))
