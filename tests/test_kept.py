"""Tables kept up to date: state of streams, sums by run, as-of rows, files by place."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from galecast.operators.asof import asof_rows
from galecast.plans import gold
from galecast.sources.tables import interleaved, read_table, runs_to_build, write_clustered, write_table
from galecast.streaming import daily, dedupe

SCORED = "dt string, admin_names string, fcstDate string, fcstTime string, R_total double"


def scored(run: str, n: int, shift: float = 0.0, day: int = 1) -> list[tuple]:
    rng = random.Random(f"{run}{n}")
    return [(run, f"r{rng.randrange(5)}", f"202508{day + rng.randrange(3):02d}", f"{rng.randrange(24):02d}00", rng.randrange(100) / 128 + shift) for _ in range(n)]


def table(df) -> list[tuple]:
    return sorted((r.date, r.admin_names, round(r.r_total_avg, 9), r.r_total_max, r.max_time, r.obs_cnt) for r in df.collect())


def test_state_of_the_daily_stream_is_bounded(spark, tmp_path):
    source = str(tmp_path / "in")
    for i in range(5):
        spark.createDataFrame(scored("2025080100", 40, day=1 + 3 * i), SCORED).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCORED).option("maxFilesPerTrigger", 1).parquet(source)
    query = daily.keep_daily(stream, str(tmp_path / "daily"), str(tmp_path / "progress"), window="1 second", delay="0 seconds")
    query.awaitTermination()
    keys = spark.read.parquet(str(tmp_path / "daily")).count()
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert keys > 60 and max(sizes) < keys * 0.7  # sums of windows that are over leave the state
    stored = spark.read.schema(daily.SUMS).parquet(daily.sums_path(str(tmp_path / "daily")))
    assert stored.count() == keys
    assert table(read_table(spark, str(tmp_path / "daily"))) == table(gold.daily(spark.read.schema(SCORED).parquet(source)))


def test_newest_row_of_a_key_through_the_state(spark, tmp_path):
    schema = "nx int, ny int, fcstDate string, fcstTime string, category string, fcstValue string, seq long"
    landed, path = str(tmp_path / "in"), str(tmp_path / "table")

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        dedupe.keep_newest(stream, path, str(tmp_path / "progress"), ["seq"], window="1 second", delay="0 seconds").awaitTermination()
        return {(str(r.fcstDate), r.fcstValue) for r in spark.read.parquet(path).collect()}

    def item(date, value, seq):
        return (1, 1, date, "0600", "T1H", value, seq)

    assert arrive(item("20250810", "new", 5), item("20250810", "old", 4), item("20250810", "new", 5)) == {("20250810", "new")}
    assert arrive(item("20250801", "late", 1), item("20250810", "older", 3)) == {("20250810", "new"), ("20250801", "late")}
    assert arrive(item("20250801", "corrected", 9)) == {("20250810", "new"), ("20250801", "corrected")}
    changed = spark.createDataFrame([item("20250801", "late", 1)], schema)
    dedupe.upsert_newest(changed, path, (*dedupe.KEYS, "category"), ["seq"], "fcstDate")  # a batch brought again
    assert {r.fcstValue for r in spark.read.parquet(path).collect()} == {"new", "corrected"}


def test_gold_reads_only_runs_that_are_new_or_written_again(spark, tmp_path):
    silver, out, partials = (str(tmp_path / n) for n in ("silver", "gold", "partials"))

    def put(rows):
        write_table(spark.createDataFrame(rows, SCORED), silver, ["dt"])

    def bring_up_to_date():
        return gold.run_daily_incremental(spark, silver, out, partials)

    put(scored("2025080100", 50) + scored("2025080106", 50, shift=1.0) + scored("2025080112", 50))
    assert bring_up_to_date() == ["2025080100", "2025080106", "2025080112"]
    assert bring_up_to_date() == []
    put(scored("2025080106", 30))
    assert bring_up_to_date() == ["2025080106"]
    assert table(read_table(spark, out)) == table(gold.daily(read_table(spark, silver)))
    put(scored("2025080118", 20, day=20))
    assert bring_up_to_date() == ["2025080118"]
    assert table(read_table(spark, out)) == table(gold.daily(read_table(spark, silver)))


def test_runs_to_build(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def put(path, *runs):
        write_table(spark.createDataFrame([(r, 1) for r in runs], "dt string, nx int"), path, ["dt"])

    put(f"{bronze}/ultra_shortfcst", "2025080100", "2025080106")
    assert runs_to_build(spark, bronze, silver) == ["2025080100", "2025080106"]
    put(silver, "2025080100")
    assert runs_to_build(spark, bronze, silver) == ["2025080106"]
    put(silver, "2025080106")
    assert runs_to_build(spark, bronze, silver) == []
    put(f"{bronze}/ultra_shortfcst", "2025080100")  # landed again
    assert runs_to_build(spark, bronze, silver) == ["2025080100"]
    assert runs_to_build(spark, str(tmp_path / "nowhere"), silver) == []


def test_summary_is_counted_while_writing(spark, tmp_path):
    silver = str(tmp_path / "silver")
    rows = spark.createDataFrame([("a", "20250801", "0300", 1, 1, 0.7, "2025080100"), ("b", "20250801", "0300", 1, 2, 0.1, "2025080100"), ("b", "20250801", "0200", 1, 2, 0.9, "2025080100")],
        "admin_names string, fcstDate string, fcstTime string, nx int, ny int, R_total double, dt string")
    write_table(rows.withColumns({f"R_{h}": F.lit(0.0) for h in ("rain", "heat", "wind", "uv", "typhoon")}), silver, ["dt"])
    assert gold.run_latest_observed(spark, silver, str(tmp_path / "gold")) == {"high_risk": 1, "total": 2}
    assert spark.read.parquet(str(tmp_path / "gold")).count() == 2


@pytest.mark.parametrize("back", [1, 48])
def test_every_row_finds_its_own_newest(spark, back):
    rng = random.Random(back)
    start = dt.datetime(2025, 8, 1)
    known = [(rng.choice(["a", "b", None]), start + dt.timedelta(minutes=rng.randrange(0, 6000, 5)), i, f"v{i}") for i in range(150)]
    asked = [(i, rng.choice(["a", "b", "c", None]), start + dt.timedelta(minutes=rng.randrange(-300, 7000, 5))) for i in range(200)] + [(999, "a", None)]
    left = spark.createDataFrame(asked, "poll int, k string, at timestamp_ntz")
    right = spark.createDataFrame(known, "k string, time timestamp_ntz, n int, v string")
    got = {r.poll: (r.time, r.n, r.v) for r in asof_rows(left, right, ["k"], "at", "time", ["n", "v"], back).collect()}
    assert len(got) == len(asked)
    for poll, k, at in asked:
        fit = [(t, n, v) for key, t, n, v in known if k is not None and key == k and at is not None and at - dt.timedelta(hours=back) <= t <= at]
        assert got[poll] == (max(fit) if fit else (None, None, None)), poll


def test_a_box_lies_in_few_files(spark, tmp_path):
    rows = spark.range(64 * 64).select((F.col("id") % 64).cast("int").alias("nx"), (F.col("id") / 64).cast("int").alias("ny"))
    box = F.col("nx").between(8, 15) & F.col("ny").between(16, 23)
    write_clustered(rows, str(tmp_path / "z"), [F.col("nx"), F.col("ny")], 16)
    rows.repartitionByRange(16, "nx").write.parquet(str(tmp_path / "x"))
    files = {n: spark.read.parquet(str(tmp_path / n)).where(box).select("_metadata.file_path").distinct().count() for n in "zx"}
    assert files["z"] <= 2 < files["x"] + 1 and spark.read.parquet(str(tmp_path / "z")).where(box).count() == 64
    code = spark.createDataFrame([(3, 5), (-1, None)], "a int, b int").select(interleaved([F.col("a"), F.col("b")]).alias("z")).collect()
    assert [r.z for r in code] == [0b100111, 0]
