"""Inputs on which earlier versions gave wrong answers or lost rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from galecast.functions.scores import percentile_scale
from galecast.operators import regions, scoring
from galecast.operators.canonical import canonicalize
from galecast.operators.percentiles import value_ranges
from galecast.sources import responses, tables
from galecast.streaming import dedupe, ingest


def test_cells_written_as_decimals_keep_their_key(spark):
    df = spark.createDataFrame([("41.0", " 41 "), ("41", "x"), (None, "41.7")], "nx string, ny string")
    assert [tuple(r) for r in canonicalize(df).collect()] == [(41, 41), (41, None), (None, 41)]


def test_infinite_values_score_as_missing(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (None,), (5.0,)], "v double")
    scaled = df.select(percentile_scale(F.col("v"), F.lit(0.0), F.lit(10.0)).alias("s"))
    assert [r.s is None for r in scaled.collect()] == [True, True, True, False]


def test_an_outlier_does_not_fill_one_interval(spark):
    counted = spark.range(20_000).select(F.lit("r").alias("dt"), F.lit(0).alias("_m"), (F.col("id") * 0.003).alias("_v"), F.lit(1).alias("_n"))
    counted = counted.unionByName(spark.createDataFrame([("r", 0, 1e9, 7)], "dt string, _m int, _v double, _n int"))
    rows = value_ranges(counted, ["dt"], 64).orderBy("_low").collect()
    assert sum(r["_values"] for r in rows) == 20_001 and max(r["_values"] for r in rows) < 1500
    assert {r["_size"] for r in rows} == {20_007}
    assert [r["_before"] for r in rows] == [sum(x["_count"] for x in rows[:i]) for i in range(len(rows))]
    assert all(a["_high"] < b["_low"] for a, b in zip(rows, rows[1:]))


def test_temperature_stands_in_where_there_is_no_t1h_column(spark):
    rows = spark.createDataFrame([("r", 38.0, 50.0, 2.0)], "dt string, TMP double, REH double, WSD double")
    heat = {"heat": scoring.HAZARDS["heat"]}
    absent = scoring.score_all(rows, heat, {"heat": 1.0}).first()["R_heat"]
    empty = scoring.score_all(rows.withColumn("T1H", F.lit(None).cast("double")), heat, {"heat": 1.0}).first()["R_heat"]
    assert absent == empty and absent > 0.8


def test_of_two_rows_of_a_region_the_placed_one_counts(spark):
    points = spark.createDataFrame([("a", "n", None, None), ("a", "n", 37.5, 127.0)], "admin_code string, admin_name string, lat double, lon double")
    row = regions.region_dimension(points).first()
    assert (row.lat, row.lon) == (37.5, 127.0) and row.nx is not None


def body(items, code: str = "00") -> str:
    return json.dumps({"response": {"header": {"resultCode": code, "resultMsg": "x"}, "body": {"items": {"item": items}}}})


ITEM = {"baseDate": "20250801", "baseTime": "0500", "category": "T1H", "fcstDate": "20250801", "fcstTime": "0600", "fcstValue": "1"}


def test_every_response_is_items_or_no_data_or_quarantine(spark):
    texts = [body(ITEM), body([ITEM, ITEM]), body("oops"), body(None), body([], "00"), body(ITEM, "99"), "<x/>", None]
    texts.append(json.dumps({"response": {"header": {"resultCode": "03", "resultMsg": "NO_DATA"}}}))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    triaged = responses.triage(df)
    with_items = {r.id for r in responses.explode_items(triaged, keep=("id",)).collect()}
    refused = {r.id for r in responses.quarantine(triaged).collect()}
    no_data = {r.id for r in triaged.where("status = 'no_data'").collect()}
    assert (with_items, refused, no_data) == ({0, 1}, {2, 3, 4, 5, 6, 7}, {8})


def test_envelope_is_read_once(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.createDataFrame([(body(ITEM),)], "text string").write.parquet(path)
    items = responses.explode_items(responses.triage(spark.read.parquet(path)))
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructField(header") + plan.count("from_json(StructField(response") <= 2, plan


def test_stream_takes_the_asked_cell_and_keeps_refused_responses(spark, tmp_path):
    folder = tmp_path / "landed" / "nx=5" / "ny=6"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(body(ITEM))
    (folder / "b.json").write_text("not json")
    texts = ingest.landed_texts(spark, f"{tmp_path}/landed/*/*")
    ingest.ingest(texts, str(tmp_path / "bronze"), "items", str(tmp_path / "c1")).awaitTermination()
    ingest.ingest_quarantine(texts, str(tmp_path / "refused"), str(tmp_path / "c2")).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "bronze" / "items")).first()
    assert (int(row.nx), int(row.ny), row.fcstValue) == (5, 6, "1")
    refused = spark.read.parquet(str(tmp_path / "refused")).collect()
    assert [(r.status, r.text) for r in refused] == [("not_json", "not json")]


def test_wide_whole_numbers_can_be_read_and_missing_runs_raise(spark, tmp_path):
    root = str(tmp_path)
    feed = tables.BASE_FEED
    whole = [f.name for f in tables.FEEDS[feed].fields if f.dataType.simpleString() == "int"]
    empty = spark.createDataFrame([tuple(None for _ in tables.FEEDS[feed].fields)], tables.FEEDS[feed])
    rows = empty.withColumns({c: F.lit(7).cast("long") for c in whole})
    tables.land_feed(rows, root, feed, "2025080103")
    got = tables.scan_run(spark, root, feed, "2025080103")
    assert {got.schema[c].dataType.simpleString() for c in whole} == {"int"}
    assert all(got.first()[c] == 7 for c in whole)
    with pytest.raises(FileNotFoundError, match="2025080104"):
        tables.scan_feeds(spark, root, ["2025080103", "2025080104"])


def test_run_column_of_a_stored_table_is_text(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([("2025080103", 1)], "dt string, v int"), path, ["dt"])
    assert dict(tables.read_table(spark, path).dtypes)["dt"] == "string"


def test_newest_item_wins_and_late_items_stay(spark, tmp_path):
    schema = "nx int, ny int, fcstDate string, fcstTime string, category string, fcstValue string, seq long"
    landed, table = str(tmp_path / "in"), str(tmp_path / "table")

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        dedupe.append_items(stream, table, str(tmp_path / "progress")).awaitTermination()
        stored = spark.read.schema(schema).parquet(table)
        return {(r.fcstDate, r.fcstValue) for r in dedupe.newest_items(stored, ["seq"]).collect()}

    assert arrive((1, 1, "20250810", "0600", "T1H", "new", 5), (1, 1, "20250810", "0600", "T1H", "old", 4)) == {("20250810", "new")}
    got = arrive((1, 1, "20250801", "0600", "T1H", "late", 1), (1, 1, "20250810", "0600", "T1H", "older", 3))
    assert got == {("20250810", "new"), ("20250801", "late")}
