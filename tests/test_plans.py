"""What the physical plans must look like at scale."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from galecast.operators.coalesce import Feed, coalesce_join, merge_feeds
from galecast.operators.keys import newest_per_key
from galecast.operators.percentiles import scope_percentiles
from galecast.operators.regions import attach_regions
from galecast.operators import scoring
from galecast.plans import gold, silver


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
# Sizes scaled down so that a small table counts as skewed.
SMALL_SKEW = {
    **NO_BROADCAST,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10kb",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def same(text):
    """One value in all rows, which Spark does not know to be a constant."""
    return F.concat(F.lit(text[:-1]), (F.col("id") % 1 + int(text[-1])).cast("string"))


def hot(spark, n=60000):
    """A third of the rows in one cell and hour."""
    return spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("int").alias("nx"),
        (F.col("id") % 1).cast("int").alias("ny"), same("20250801").alias("fcstDate"), same("0300").alias("fcstTime"),
        F.col("id").cast("double").alias("T1H"), F.lit(None).cast("double").alias("WSD"),
    )


def right_feed(spark):
    return spark.range(500).select(
        F.col("id").cast("int").alias("nx"), (F.col("id") % 1).cast("int").alias("ny"),
        same("20250801").alias("fcstDate"), same("0300").alias("fcstTime"), F.col("id").cast("double").alias("WSD"),
    )


def test_a_full_key_is_split_in_the_coalesce_join(spark):
    with settings(spark, **SMALL_SKEW):
        joined = coalesce_join(hot(spark), right_feed(spark), ["WSD"])
        assert "skew=true" in final_plan(joined)
        assert joined.where("WSD <> nx OR WSD IS NULL").count() == 0
        assert joined.count() == 60000


def test_a_full_cell_is_split_when_labels_are_attached(spark):
    regions = spark.range(500).select(
        F.col("id").cast("int").alias("nx"), (F.col("id") % 1).cast("int").alias("ny"),
        F.concat(F.lit("r"), "id").alias("admin_name"),
    )
    with settings(spark, **SMALL_SKEW):
        labelled = attach_regions(hot(spark), regions)
        assert "skew=true" in final_plan(labelled)
        assert labelled.where("admin_names = concat('r', nx)").count() == 60000


def test_a_merge_shuffles_every_side_once(spark):
    feeds = [Feed(str(i), right_feed(spark).withColumn("WSD", F.col("WSD") + i), ["WSD"]) for i in range(3)]
    with settings(spark, **NO_BROADCAST):
        plan = final_plan(merge_feeds(newest_per_key(hot(spark), ["nx", "ny", "fcstDate", "fcstTime"]), feeds, unique_base=True))
    assert plan.count("SortMergeJoin") == 3
    assert plan.count("Exchange hashpartitioning") == 4


def test_newest_row_is_picked_before_the_shuffle(spark):
    df = hot(spark).withColumn("id", F.col("nx")).select(
        F.concat(F.lit("r"), "nx").alias("admin_names"), "*", same("2025080103").alias("dt"), F.col("T1H").alias("R_total"),
        *[F.lit(0.0).alias(f"R_{h}") for h in ("rain", "heat", "wind", "uv", "typhoon")],
    )
    plan = gold.latest(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_daily_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "silver")
    hot(spark, 100).select(
        F.concat(F.lit("r"), "nx").alias("admin_names"), "*", F.col("T1H").alias("R_total"), F.lit("2025080103").alias("dt")
    ).write.partitionBy("dt").parquet(path)
    plan = gold.daily(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<admin_names:string,fcstDate:string,fcstTime:string,R_total:double>" in plan
    assert "PushedFilters: [IsNotNull(admin_names)]" in plan


def test_percentiles_count_each_value_once(spark):
    df = spark.range(1000).select(F.lit("r").alias("dt"), (F.col("id") % 7).cast("double").alias("v"))
    with settings(spark, **NO_BROADCAST):
        plan = final_plan(scope_percentiles(df, F.col("v"), ["dt"], (0.05, 0.95), ("a", "b")))
    assert "percentile" not in plan.lower()
    assert plan.count("rangepartitioning") == 1
    # The count, by its hash; the intervals; the values in which a rank lies.
    assert plan.count("ReusedExchange") == 1 and plan.count("Range (") == 1


def test_statistics_of_all_hazards_share_a_count(spark):
    df = spark.range(1000).select(
        F.lit("r").alias("dt"), (F.col("id") % 7).cast("double").alias("T1H"), F.lit(1.0).alias("TMP"),
        (F.col("id") % 11).cast("double").alias("TY_MAX_WIND"), F.lit("0300").alias("fcstTime"),
    )
    plan = scoring.score_all(df)._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Generate explode" in x]) == 2  # one count, read by ranges and by values


def test_bucketed_feeds_are_merged_without_a_shuffle(spark):
    lower = right_feed(spark).withColumn("baseDate", F.lit("20250801"))
    feeds = {
        "ultra_shortfcst": hot(spark), "short_fcst": lower.withColumn("POP", F.lit(1.0)),
        "typhoon": lower.withColumn("TY_MAX_WIND", F.lit(2.0)), "uv": lower.withColumn("UVI", F.lit(3.0)), "ultra_nowcast": None,
    }
    with settings(spark, **NO_BROADCAST):
        landed = silver.bucketed_feeds(feeds, buckets=4)
        merged = silver.merge(landed, landed=True)
        plan = final_plan(merged)
        assert merged.count() == 500
    assert plan.count("Exchange hashpartitioning") == 0 and plan.count("SortMergeJoin") == 3
    assert plan.count("Bucketed: true") == plan.count("FileScan") == 4
    assert sorted(map(str, merged.collect())) == sorted(map(str, silver.merge(feeds).collect()))


def test_silver_reads_every_feed_once(spark, tmp_path, monkeypatch):
    feeds = {}
    for name, rows in {"ultra_shortfcst": hot(spark), "short_fcst": right_feed(spark), "typhoon": right_feed(spark).withColumn("TY_MAX_WIND", F.col("WSD")).drop("WSD"), "uv": right_feed(spark).withColumn("UVI", F.lit(3)).drop("WSD")}.items():
        rows.write.parquet(str(tmp_path / name))
        feeds[name] = spark.read.parquet(str(tmp_path / name))
    plans = []
    kept = silver.stored
    monkeypatch.setattr(silver, "stored", lambda df, purpose: plans.append(final_plan(df)) or kept(df, purpose))
    with settings(spark, **NO_BROADCAST):
        rows = silver.build_silver(feeds, None, "2025080103")
        final = final_plan(rows)
    assert len(plans) == 1 and plans[0].count("FileScan") == 4 and plans[0].count("Exchange hashpartitioning") == 4
    assert all(name not in final for name in ("ultra_shortfcst", "short_fcst", "/uv"))
    assert "/merged-" in final  # the stored rows, for the numbers of the run and for the scores


def test_a_run_is_not_gathered_for_its_numbers(spark):
    df = spark.range(1000).select(same("2025080103").alias("dt"), F.lit("0300").alias("fcstTime"), (F.col("id") % 11).cast("double").alias("TY_MAX_WIND"))
    plan = scoring.score_all(df)._jdf.queryExecution().executedPlan().toString()
    to_rows = [x for x in plan.splitlines() if "LeftOuter" in x]
    assert len(to_rows) == 1 and "BroadcastHashJoin [dt#" in to_rows[0]
