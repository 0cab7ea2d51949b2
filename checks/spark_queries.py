"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.adapters import Tables
from galecast.functions import clock, precip
from galecast.functions import scores as S
from galecast.functions.geo import grid_cell
from galecast.functions.numeric import pick_number
from galecast.operators import asof, regions, scoring, series, slots, storm, uv, wide
from galecast.operators.canonical import canonicalize
from galecast.operators.coalesce import KEYS, coalesce_join
from galecast.operators.keys import newest_per_key
from galecast.operators.percentiles import RUN, join_scope, scope_percentiles
from galecast.plans import alerts, bronze, features, gold, silver
from galecast.sources import responses
from galecast.sources.schemas import FEEDS, REGIONS
from galecast.sources.tables import (
    land_feed, read_dimension, read_table, runs_to_build, scan_run, shared_folder, stored, write_clustered, write_table,
)
from galecast.streaming import daily as stream_daily
from galecast.streaming import dedupe as stream_dedupe
from galecast.streaming import ingest as stream_ingest

RUN_DT = "2025080112"
SCORES = ("R_rain", "R_heat", "R_wind", "R_uv", "R_typhoon", "R_total")


def r6(column: Column | str) -> Column:
    """Six decimals by the same arithmetic in both engines.

    Not cut at exact halves: scores made of short decimals often end there, and
    the last bit, which may differ between engines, would decide.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.floor(c * 1e6 + 0.49).cast("double") / 1e6


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def now_of(t: Tables) -> Column:
    return t("fx_poll").select(clock.compact_clock(F.col("now_text"))).scalar()


def hour_text(column: str) -> Column:
    return F.date_format(column, "yyyyMMddHHmm")


# ---- sources and sinks ---------------------------------------------------


def landed_runs(t: Tables) -> str:
    root = shared_folder(t.spark, "bronze")
    land_feed(t("fx_base_runs"), root, "ultra_shortfcst")
    return root


def scan_run_partition(t: Tables) -> DataFrame:
    rows = scan_run(t.spark, landed_runs(t), "ultra_shortfcst", "2025080106", t("fx_base").schema)
    return rows.select(*KEYS, "seq", "T1H", "dt")


def bronze_partitioned(t: Tables) -> DataFrame:
    root = landed_runs(t)
    land_feed(t("fx_base_runs"), root, "ultra_shortfcst")  # a rerun replaces, it does not add
    table = t.spark.read.schema(t("fx_base_runs").schema).parquet(f"{root}/ultra_shortfcst")
    return table.groupBy("dt").agg(
        F.count("*").alias("n_rows"), F.min("seq").alias("min_seq"), F.max("seq").alias("max_seq")
    )


def response_triage(t: Tables) -> DataFrame:
    triaged = responses.triage(t("fx_responses").select("event_id", "text"))
    return triaged.select("event_id", "status")


def response_quarantine(t: Tables) -> DataFrame:
    refused = responses.quarantine(responses.triage(t("fx_responses").select("event_id", "text")))
    return refused.select("event_id", "status")


def raw_items_explode(t: Tables) -> DataFrame:
    asked = t("fx_responses").select(
        "event_id", F.col("nx").alias("asked_nx"), F.col("ny").alias("asked_ny"), "text"
    )
    items = responses.explode_items(
        responses.triage(asked), keep=("event_id", "asked_nx", "asked_ny")
    )
    filled = responses.fill_cells(items, F.col("asked_nx"), F.col("asked_ny"))
    return filled.select(
        "event_id", "pos", "nx", "ny", "baseDate", "baseTime", "fcstDate", "fcstTime", "category", "fcstValue"
    )


def call_list_clean(t: Tables) -> DataFrame:
    return regions.clean_calls(t("fx_calls"))


def region_map_clean(t: Tables) -> DataFrame:
    return regions.clean_region_map(t("fx_region_map"))


# ---- projection ------------------------------------------------------------


def canonical(t: Tables) -> DataFrame:
    return canonicalize(t("fx_raw_wide"))


def pick_max_variants(t: Tables) -> DataFrame:
    df = t("fx_score").withColumnRenamed("RN1", "PCP_text")
    return df.select(
        "dt", "seq",
        pick_number(df, ["WSD"]).alias("wsd"),
        r6(precip.pick_mm(df, ["PCP"])).alias("pcp"),
    )


def fcst_timestamp(t: Tables) -> DataFrame:
    ts = clock.forecast_clock(F.col("fcstDate"), F.col("fcstTime"))
    return canonicalize(t("fx_raw_wide")).select(
        "seq", ts.alias("fcst_ts"), F.unix_seconds(clock.zoned_instant(ts)).alias("instant")
    )


def risk_level(t: Tables) -> DataFrame:
    total = F.when(F.col("REH").isNotNull(), F.col("REH") / 1e2)
    return t("fx_base").select("seq", S.risk_level(total).alias("risk_level"))


def run_dt(t: Tables) -> DataFrame:
    return t.given("events").select("event_id", clock.run_hour(F.col("ts")).alias("dt"))


# ---- joins -----------------------------------------------------------------


def nowcast_with_time(t: Tables) -> DataFrame:
    return wide.nowcast_at_base_time(t("fx_nc"))


def coalesce_join_query(t: Tables) -> DataFrame:
    return coalesce_join(
        t("fx_base"), nowcast_with_time(t), ["T1H", "REH", "WSD"], order_by=["seq"]
    )


def feeds(t: Tables) -> dict[str, DataFrame]:
    return {
        "ultra_shortfcst": t("fx_base"),
        "ultra_nowcast": t("fx_nc"),
        "short_fcst": t("fx_vil"),
        "typhoon": t("fx_ty"),
        "uv": t("fx_uv"),
    }


def silver_merge(t: Tables) -> DataFrame:
    return silver.merge(feeds(t), order_by=["seq"], nowcast_valid_time="base")


def region_labels(t: Tables) -> DataFrame:
    comma = regions.region_labels(t("fx_regions"), ", ").withColumnRenamed("admin_names", "names_comma")
    return regions.region_labels(t("fx_regions")).join(comma, ["nx", "ny"])


def attach_regions(t: Tables) -> DataFrame:
    return regions.attach_regions(t("fx_base").select(*KEYS, "seq"), t("fx_regions"))


# ---- long to wide, keys ----------------------------------------------------


def short_fcst_wide(t: Tables) -> DataFrame:
    w = wide.short_forecast_wide(t("fx_items"))
    return w.select(
        *KEYS, F.unix_seconds("valid_ts_kst").alias("valid_instant"),
        r6("PCP").alias("PCP"), r6("POP").alias("POP"), "PTY", r6("REH").alias("REH"), "SKY",
        r6("TMP").alias("TMP"), r6("WSD").alias("WSD"),
    )


def nowcast_wide(t: Tables) -> DataFrame:
    items = t("fx_items_based").withColumnRenamed("fcstValue", "obsrValue").drop("fcstDate", "fcstTime")
    return wide.latest_wide(items, ("PCP", "PTY", "REH", "TMP", "WSD"))


def dedupe_keys(t: Tables) -> DataFrame:
    return newest_per_key(t("fx_base"), KEYS, ["seq"])


def feeds_union(t: Tables) -> DataFrame:
    base = t("fx_base").select(*KEYS, "seq", "T1H", "WSD")
    other = t("fx_vil").select(*KEYS, "seq", "POP", "WSD")
    return wide.union_feeds([base, other])


def region_dimension(t: Tables) -> DataFrame:
    return regions.region_dimension(t("fx_points"))


def grid_assign(t: Tables) -> DataFrame:
    nx, ny = grid_cell(F.col("lat"), F.col("lon"))
    return t("fx_regions").select("admin_code", nx.alias("nx"), ny.alias("ny"))


def grid_unique(t: Tables) -> DataFrame:
    return rounded(regions.unique_grid(regions.assign_cells(t("fx_points"))), "lat", "lon")


def call_list_unique(t: Tables) -> DataFrame:
    return rounded(regions.unique_calls(t("fx_regions")), "lat", "lon")


def sample_cells(t: Tables) -> DataFrame:
    return regions.sample_cells(t("fx_regions"), 20).select("admin_code", "nx", "ny")


# ---- amounts ---------------------------------------------------------------


def amounts(reader) -> Callable[[Tables], DataFrame]:
    return lambda t: t("fx_amounts").select("event_id", r6(reader(F.col("txt"))).alias("mm"))


# ---- scores ----------------------------------------------------------------


def percentile_minmax(t: Tables) -> DataFrame:
    df = t("fx_ty_runs").select("dt", "seq", "TY_DISTANCE_KM")
    edges = scope_percentiles(df, F.col("TY_DISTANCE_KM"), RUN, (0.05, 0.95), ("p5", "p95"))
    scaled = S.percentile_scale(F.col("TY_DISTANCE_KM"), F.col("p5"), F.col("p95"))
    placed = join_scope(df, edges, RUN, few=True)
    return placed.select("dt", "seq", r6("p5").alias("p5"), r6("p95").alias("p95"), r6(scaled).alias("scaled"))


def scored(name: str, without: tuple[str, ...] = ()) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        df = scoring.add_scores(t("fx_score").drop(*without), {name: scoring.HAZARDS[name]})
        return df.select("dt", "seq", r6(f"R_{name}").alias(f"R_{name}"))

    return query


def score_all(t: Tables) -> DataFrame:
    return rounded(scoring.score_all(t("fx_score")).select("dt", "seq", *SCORES), *SCORES)


def total_risk(t: Tables) -> DataFrame:
    df = t("fx_base").select(
        "seq", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("T1H", "REH", "WSD", "UUU", "SKY")]
    )
    parts = {
        "rain": F.col("T1H") / 40.0, "heat": F.col("REH") / 100.0, "wind": F.col("WSD") / 30.0,
        "uv": F.col("UUU") / 10.0, "typhoon": F.col("SKY") / 4.0,
    }
    return df.select("seq", r6(S.total_score(parts)).alias("R_total"))


# ---- time series -----------------------------------------------------------


def track(t: Tables, by: tuple[str, ...] = ()) -> DataFrame:
    return storm.clean_track(t("fx_track").drop("tmFc"), keep=(*by, "seq"))


def track_clean(t: Tables) -> DataFrame:
    return track(t, ("storm",)).select("storm", "seq", hour_text("time").alias("time"), "lat", "lon", "wind")


def storm_hourly(t: Tables) -> DataFrame:
    points = storm.one_point_per_time(track(t, ("storm",)), ["storm"], ["seq"])
    return storm.hourly_track(points, ["storm"])


def track_hourly(t: Tables) -> DataFrame:
    df = rounded(storm_hourly(t), "lat", "lon", "wind")
    return df.select("storm", hour_text("time").alias("time"), "lat", "lon", "wind")


def forecast_hours(t: Tables) -> DataFrame:
    return slots.all_forecast_hours([t("fx_base"), t("fx_items")])


def track_align(t: Tables) -> DataFrame:
    wanted = forecast_hours(t).agg(F.collect_set("ts")).scalar()
    storms = t("fx_track").select("storm").distinct().withColumn("time", F.explode(wanted))
    df = rounded(storm.align_track(storm_hourly(t), storms, ["storm"]), "lat", "lon", "wind")
    return df.select("storm", hour_text("time").alias("time"), "lat", "lon", "wind")


def interp_series(t: Tables) -> DataFrame:
    """Wind between its own points, at every time of the storm's positions, ends held."""
    points = storm.one_point_per_time(track(t, ("storm",)), ["storm"], ["seq"])
    wanted = points.select("storm", clock.plus_minutes(F.col("time"), 25).alias("time"))
    df = rounded(series.interpolate(points, wanted, ["storm"], ["wind"]), "wind")
    return df.select("storm", hour_text("time").alias("time"), "wind")


def storm_distance(t: Tables) -> DataFrame:
    feed = storm.build_storm_feed(
        regions.unique_grid(t("fx_regions")), track(t), slots.hours_or_last(forecast_hours(t), clock.now_clock()), ["seq"]
    )
    return rounded(feed, "TY_DISTANCE_KM", "TY_MAX_WIND")


def storm_latest_announcement(t: Tables) -> DataFrame:
    return storm.latest_announcement(t("fx_track"), ["storm"])


def target_hours(t: Tables) -> DataFrame:
    return slots.newest_hours(forecast_hours(t)).select(hour_text("ts").alias("ts"))


def storm_target_slots(t: Tables) -> DataFrame:
    return slots.last_hours(forecast_hours(t), clock.now_clock()).select(hour_text("ts").alias("ts"))


def issue_time(t: Tables) -> DataFrame:
    return slots.poll_bases(t.given("events").select("event_id", "ts"), "ts").select(
        "event_id", "baseDate", "baseTime"
    )


def target_slots(t: Tables) -> DataFrame:
    polls = slots.poll_bases(t.given("events").select("event_id", "ts"), "ts")
    return slots.target_slots(polls, now="ts").select("event_id", "fcstDate", "fcstTime")


def poll_slots(t: Tables) -> tuple[DataFrame, DataFrame]:
    polls = slots.poll_bases(t("fx_poll").select(clock.compact_clock(F.col("now_text")).alias("now")))
    return slots.target_slots(polls), slots.target_slots(polls, now=None)


def target_slots_semi(t: Tables) -> DataFrame:
    return slots.keep_slots(t("fx_items_based"), poll_slots(t)[0])


def target_slots_fallback(t: Tables) -> DataFrame:
    return slots.keep_slots_or_fallback(t("fx_items_based"), *poll_slots(t))


def latest_base_asof(t: Tables) -> DataFrame:
    newest = clock.nowcast_base(clock.compact_clock(F.col("now_text")))
    kept = asof.latest_base(t("fx_items_based"), t("fx_poll").select(newest).scalar())
    return kept.select("nx", "ny", "baseDate", "baseTime", "seq", "category", "fcstValue")


def uv_items(t: Tables) -> DataFrame:
    hourly = F.create_map(
        F.lit("h0"), F.col("v0"), F.lit("H3"), F.col("v3"), F.lit("h6"), F.col("v6"), F.lit("h100"), F.lit("9")
    )
    single = F.create_map(F.lit("uvIndex"), F.col("v3"), F.lit("code"), F.lit("A07"))
    item = F.when(F.col("kind") == "click", single).when(
        F.col("kind") == "signup", F.create_map(F.lit("h0"), F.lit(""), F.lit("h3"), F.col("v3"))
    ).otherwise(hourly)
    return t("fx_uv_items").select(
        "admin_code", clock.compact_clock(F.col("base_text")).alias("base_ts"), "seq", item.alias("item")
    )


def uv_offsets(t: Tables) -> DataFrame:
    values = uv.offsets(uv_items(t))
    return values.select("admin_code", hour_text("base_ts").alias("base_ts"), "offset", "value")


def uv_asof_base(t: Tables) -> DataFrame:
    based = uv.newest_base(uv.offsets(uv_items(t)), now_of(t))
    return based.select("admin_code", hour_text("base_ts").alias("base_ts"), "offset", "value")


def uv_hourly(t: Tables) -> DataFrame:
    poll = t("fx_poll").select(clock.compact_clock(F.col("now_text")).alias("ts"))
    hours = slots.last_hours(poll, clock.now_clock(), 12)
    return uv.build_uv_feed(uv_items(t), t("fx_regions"), hours)


# ---- whole jobs ------------------------------------------------------------


def silver_rows(t: Tables) -> DataFrame:
    return silver.build_silver(feeds(t), t("fx_regions"), RUN_DT, order_by=["seq"])


def silver_build(t: Tables) -> DataFrame:
    return rounded(silver_rows(t).drop("ingested_at"), *SCORES)


def silver_build_bucketed(t: Tables) -> DataFrame:
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    landed = silver.bucketed_feeds(feeds(t), buckets=buckets, order_by=["seq"])
    rows = silver.build_silver(landed, t("fx_regions"), RUN_DT, order_by=["seq"], landed=True)
    return rounded(rows.drop("ingested_at"), *SCORES)


def silver_backfill(t: Tables) -> DataFrame:
    runs = {
        "ultra_shortfcst": t("fx_base_runs"), "short_fcst": t("fx_vil_runs"), "typhoon": t("fx_ty_runs"),
    }
    return rounded(
        silver.build_silver(runs, t("fx_regions"), None, order_by=["seq"]).drop("ingested_at"), *SCORES
    )


def silver_table(t: Tables) -> str:
    path = shared_folder(t.spark, "silver")
    write_table(silver_rows(t), path, ["dt"])
    return path


def silver_written(t: Tables) -> DataFrame:
    return rounded(read_table(t.spark, silver_table(t)).drop("ingested_at"), *SCORES)


def gold_written(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "gold")
    gold.run_latest(t.spark, silver_table(t), path)
    return rounded(read_table(t.spark, path), *SCORES)


def gold_daily_written(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "gold")
    gold.run_daily(t.spark, silver_table(t), path)
    return rounded(read_table(t.spark, path), "r_total_avg", "r_total_max")


def gold_latest_rows(t: Tables) -> DataFrame:
    return gold.latest(silver_rows(t))


def gold_latest(t: Tables) -> DataFrame:
    return rounded(gold_latest_rows(t), *SCORES)


def gold_daily(t: Tables) -> DataFrame:
    return rounded(gold.daily(silver_rows(t)), "r_total_avg", "r_total_max")


def export_latest(t: Tables) -> DataFrame:
    return rounded(gold.export_latest(gold_latest_rows(t)), "R_total")


def export_daily(t: Tables) -> DataFrame:
    return rounded(gold.export_daily(gold.daily(silver_rows(t))), "r_total_avg", "r_total_max")


def alert_rows(t: Tables) -> DataFrame:
    return rounded(alerts.alert_rows(gold_latest_rows(t)), *SCORES)


def alert_lines(t: Tables) -> DataFrame:
    return alerts.alert_lines(rounded(gold_latest_rows(t), "R_total"))


def run_summary(t: Tables) -> DataFrame:
    return alerts.run_summary(gold_latest_rows(t))


def feed_summary(t: Tables) -> DataFrame:
    return alerts.feed_summary(t("fx_ty"))


def geojson_features(t: Tables) -> DataFrame:
    newest = rounded(gold.newest_per_region(silver_rows(t)), *SCORES)
    text = features.geojson_features(newest, t("fx_regions"))

    def at(path: str, kind: str = "string") -> Column:
        return F.get_json_object("feature", path).cast(kind)

    return text.select(
        at("$.type").alias("kind"), at("$.geometry.type").alias("shape"),
        r6(at("$.geometry.coordinates[0]", "double")).alias("lon"),
        r6(at("$.geometry.coordinates[1]", "double")).alias("lat"),
        at("$.properties.admin_code").alias("admin_code"),
        at("$.properties.admin_names").alias("admin_names"),
        at("$.properties.R_total", "double").alias("R_total"),
        at("$.properties.T1H", "double").alias("T1H"),
        at("$.properties.fcstTime").alias("fcstTime"),
    )


# ---- streams ---------------------------------------------------------------


def file_stream(t: Tables, name: str) -> DataFrame:
    schema = t.given(name).schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.sf_dir)


def streamed(t: Tables, name: str, given: str) -> DataFrame:
    """A feed made of a stream over the given table instead of the table."""
    from checks.adapters import TABLES

    return t.spark.sql(TABLES[name], **{given: file_stream(t, given)})


def collected(t: Tables, *feeds: str) -> str:
    """Bronze root after the stream of landed responses has been taken in."""
    root = shared_folder(t.spark, "collect")
    landed = streamed(t, "fx_landed", "events").select(*bronze.ASKED, "text")
    calls, grid = regions.unique_calls(t("fx_regions")), regions.unique_grid(t("fx_regions"))
    bronze.collect(landed, root, f"{root}/progress", calls, grid, feeds).awaitTermination()
    return root


def bronze_feed(name: str, *measures: str) -> Callable[[Tables], DataFrame]:
    """A feed as silver reads it, over all runs."""

    def query(t: Tables) -> DataFrame:
        root = collected(t, name)
        rows = scan_run(t.spark, root, name, ["2025080516", "2025081516", "2025082516"])
        if "valid_ts_kst" in rows.columns:
            rows = rows.withColumn("valid_ts_kst", F.unix_seconds("valid_ts_kst"))
        return rounded(rows, *measures)

    return query


def bronze_counts(t: Tables) -> DataFrame:
    """Responses of every run by the part they are in."""
    rows = bronze.read_landed(t.spark, collected(t))
    return rows.groupBy("dt", "part", "status").agg(F.count_distinct("seq").alias("responses"), F.count("item").alias("items"))


def bronze_quarantine(t: Tables) -> DataFrame:
    return bronze.quarantined(t.spark, collected(t)).select("seq", "service", "dt", "status", "text")


def bronze_to_gold(t: Tables) -> DataFrame:
    """Daily statistics of landed responses: bronze, silver and gold one after the other."""
    root = collected(t, *FEEDS)
    for run in ("2025080516", "2025081516", "2025082516"):
        silver.run_silver(t.spark, root, f"{root}/silver", t("fx_regions"), run)
    gold.run_daily(t.spark, f"{root}/silver", f"{root}/gold")
    return read_table(t.spark, f"{root}/gold").groupBy("date").agg(F.count("*").alias("regions"), F.sum("obs_cnt").alias("rows"))


def asked_responses(t: Tables) -> DataFrame:
    """Responses with a path that tells the cell asked for."""
    cell = F.format_string("/nx=%d/ny=%d/r.json", "nx", "ny")
    return streamed(t, "fx_responses", "events").select("event_id", "text", cell.alias("file"))


def ingested(t: Tables, root: str) -> DataFrame:
    stream_ingest.ingest(asked_responses(t), root, "items", f"{root}/progress", keep=("event_id",)).awaitTermination()
    table = t.spark.read.option("inferSchema", False).parquet(f"{root}/items")
    return table.select(
        "event_id", "pos", F.col("nx").cast("int").alias("nx"), F.col("ny").cast("int").alias("ny"),
        "fcstDate", "fcstTime", "category", "fcstValue", F.col("dt").cast("string").alias("dt"),
    )


def stream_bronze_ingest(t: Tables) -> DataFrame:
    return ingested(t, shared_folder(t.spark, "stream"))


def stream_restarted(t: Tables) -> DataFrame:
    """Items per run after the stream was started again with nothing new."""
    root = shared_folder(t.spark, "stream")
    ingested(t, root)
    return ingested(t, root).groupBy("dt").agg(F.count("*").alias("items"))


def stream_quarantine(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "stream")
    landed = asked_responses(t).drop("file")
    stream_ingest.ingest_quarantine(landed, f"{root}/refused", f"{root}/progress").awaitTermination()
    return t.spark.read.parquet(f"{root}/refused").select("event_id", "status", "text")


ITEM_KEYS = ("nx", "ny", "fcstDate", "fcstTime", "category")


def stream_dedupe_items(t: Tables) -> DataFrame:
    """The newest item per key, through the state of the stream."""
    root = shared_folder(t.spark, "stream")
    stream_dedupe.keep_newest(streamed(t, "fx_items", "events"), f"{root}/table", f"{root}/progress", ["seq"]).awaitTermination()
    return read_table(t.spark, f"{root}/table").select(*ITEM_KEYS[:2], F.col("fcstDate").cast("string").alias("fcstDate"), *ITEM_KEYS[3:], "fcstValue")


def stream_append_newest(t: Tables) -> DataFrame:
    """The same from a table of all items, the newest taken on reading."""
    root = shared_folder(t.spark, "stream")
    items = streamed(t, "fx_items", "events")
    stream_dedupe.append_items(items, f"{root}/table", f"{root}/progress").awaitTermination()
    stored = t.spark.read.schema(items.schema).parquet(f"{root}/table")
    return stream_dedupe.newest_items(stored, ["seq"], ITEM_KEYS).select(*ITEM_KEYS, "fcstValue")


def stream_drop_repeats(t: Tables) -> DataFrame:
    """The keys of the items, each once."""
    root = shared_folder(t.spark, "stream")
    valid = clock.on_axis(clock.forecast_clock(F.col("fcstDate"), F.col("fcstTime")))
    items = streamed(t, "fx_items", "events").select(*ITEM_KEYS, valid.alias("at"))
    once = stream_dedupe.drop_repeats(items, "at", "60 days", ITEM_KEYS)
    writer = once.writeStream.format("parquet").option("checkpointLocation", f"{root}/progress").option("path", f"{root}/table")
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{root}/table").select(*ITEM_KEYS)


def stream_daily_stats(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "stream")
    rows = streamed(t, "fx_base", "lineitem").select(
        "fcstDate", "fcstTime", F.concat_ws("-", "nx", "ny").alias("admin_names"),
        (F.col("T1H") / 40.0).alias("R_total"),
    )
    stream_daily.keep_daily(rows, f"{root}/daily", f"{root}/progress").awaitTermination()
    return rounded(t.spark.read.parquet(f"{root}/daily"), "r_total_avg", "r_total_max")


# ---- kept up to date ---------------------------------------------------------


def gold_daily_incremental(t: Tables) -> DataFrame:
    """Daily statistics of three runs, one of which was written again after the first time."""
    root = shared_folder(t.spark, "incremental")
    runs = {"ultra_shortfcst": t("fx_base_runs"), "short_fcst": t("fx_vil_runs"), "typhoon": t("fx_ty_runs")}
    rows = stored(silver.build_silver(runs, t("fx_regions"), None, order_by=["seq"]).drop("ingested_at"), "silver")
    again = F.col("dt") == "2025080106"
    write_table(rows.withColumn("R_total", F.when(again, 2.0).otherwise(F.col("R_total"))), f"{root}/silver", ["dt"])
    gold.run_daily_incremental(t.spark, f"{root}/silver", f"{root}/gold", f"{root}/partials")
    write_table(rows.where(again), f"{root}/silver", ["dt"])
    gold.run_daily_incremental(t.spark, f"{root}/silver", f"{root}/gold", f"{root}/partials")
    return rounded(read_table(t.spark, f"{root}/gold"), "r_total_avg", "r_total_max")


def run_summary_observed(t: Tables) -> DataFrame:
    """The run summary, counted while the newest rows are written."""
    counts = gold.run_latest_observed(t.spark, silver_table(t), shared_folder(t.spark, "gold"))
    return t.spark.createDataFrame([(counts["high_risk"], counts["total"])], "high_risk long, total long")


def silver_box(t: Tables) -> DataFrame:
    """Scored rows of a box of cells and hours, from files in the interleaved order of both."""
    path = shared_folder(t.spark, "silver")
    hour = F.timestamp_diff("HOUR", F.lit("2025-01-01").cast("timestamp_ntz"), F.col("fcst_ts"))
    write_clustered(silver_rows(t), path, [F.col("nx") - 40, F.col("ny") - 60, hour], 64)
    box = F.col("nx").between(44, 47) & F.col("ny").between(60, 71) & F.col("fcstDate").between("20250803", "20250809")
    return rounded(t.spark.read.parquet(path).where(box).select(*KEYS, "R_total"), "R_total")


def asof_polls(t: Tables) -> DataFrame:
    """For every poll at ten past a half hour the newest full-hour base of its cell, at most two hours old."""
    items = t("fx_items_based").withColumn("base_ts", clock.forecast_clock(F.col("baseDate"), F.col("baseTime")))
    polls = items.where(F.minute("base_ts") == 30).select(F.col("seq").alias("poll"), "nx", "ny", clock.plus_minutes(F.col("base_ts"), 10).alias("at"))
    known = items.where(F.minute("base_ts") == 0)
    found = asof.asof_rows(polls, known, ["nx", "ny"], "at", "base_ts", ["seq", "fcstValue"], 2)
    return found.select("poll", "nx", "ny", hour_text("base_ts").alias("base_ts"), "seq", "fcstValue")


def latest_forecast_base(t: Tables) -> DataFrame:
    newest = clock.forecast_base(clock.compact_clock(F.col("now_text")))
    kept = asof.latest_base(t("fx_items_based"), t("fx_poll").select(newest).scalar())
    return kept.select("nx", "ny", "baseDate", "baseTime", "seq", "category", "fcstValue")


def xml_items(t: Tables) -> DataFrame:
    """Index responses in JSON and XML."""
    landed = t("fx_landed").where("service = 'uv'").select("seq", "text")
    items = responses.index_items(landed, keep=("seq",))
    return items.select("seq", "status", F.try_element_at("item", F.lit("h0")).alias("h0"), F.try_element_at("item", F.lit("h3")).alias("h3"))


def csv_dimension(t: Tables) -> DataFrame:
    """Regions through a CSV file with a byte-order mark and other columns than declared."""
    path = shared_folder(t.spark, "regions") + "/regions.csv"
    rows = t("fx_regions").withColumnRenamed("admin_code", "\ufeffadmin_code").withColumn("unknown", F.lit("x")).drop("ny")
    rows.write.option("header", True).csv(path)
    return rounded(read_dimension(t.spark, path, REGIONS), "lat", "lon")


def runs_due(t: Tables) -> DataFrame:
    """The landed runs that silver lacks: one was never built."""
    bronze_root, built = landed_runs(t), shared_folder(t.spark, "silver")
    write_table(t("fx_base_runs").where("dt <> '2025080106'"), built, ["dt"])
    return t.spark.createDataFrame([(r,) for r in runs_to_build(t.spark, bronze_root, built)], "dt string")


def short_fcst_unique(t: Tables) -> DataFrame:
    """Short-range rows that came twice, with the region code of their cell."""
    once = wide.with_region_code(wide.short_forecast_wide(t("fx_items")), regions.unique_calls(t("fx_regions")))
    kept = wide.unique_short_forecast(once.unionByName(once.withColumn("TMP", F.col("TMP") + 1)))
    return rounded(kept.withColumn("valid_ts_kst", F.unix_seconds("valid_ts_kst")), "PCP", "POP", "REH", "TMP", "WSD")


def feed_sorted(t: Tables) -> DataFrame:
    """Rows of a landed feed by run, and how many of them come before their predecessor in the file."""
    files = t.spark.read.schema(t("fx_base_runs").schema).parquet(f"{landed_runs(t)}/ultra_shortfcst")
    order = F.struct("fcstDate", "fcstTime", "nx", "ny")
    placed = files.select("dt", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), order.alias("key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    return placed.withColumn("before", before).groupBy("dt").agg(F.count("*").alias("n_rows"), F.count_if(F.col("key") < F.col("before")).alias("inversions"))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "scan_run_partition": scan_run_partition,
    "bronze_partitioned": bronze_partitioned,
    "response_triage": response_triage,
    "response_quarantine": response_quarantine,
    "raw_items_explode": raw_items_explode,
    "call_list_clean": call_list_clean,
    "region_map_clean": region_map_clean,
    "canonicalize": canonical,
    "pick_max_variants": pick_max_variants,
    "fcst_timestamp": fcst_timestamp,
    "risk_level": risk_level,
    "run_dt": run_dt,
    "coalesce_join": coalesce_join_query,
    "silver_merge": silver_merge,
    "region_labels": region_labels,
    "attach_regions": attach_regions,
    "short_fcst_wide": short_fcst_wide,
    "nowcast_wide": nowcast_wide,
    "dedupe_keys": dedupe_keys,
    "feeds_union": feeds_union,
    "region_dimension": region_dimension,
    "grid_assign": grid_assign,
    "grid_unique": grid_unique,
    "call_list_unique": call_list_unique,
    "sample_cells": sample_cells,
    "parse_mm_range": amounts(precip.mm_range),
    "parse_mm_search": amounts(precip.mm_search),
    "parse_mm_collector": amounts(precip.mm_collector),
    "percentile_minmax": percentile_minmax,
    "rain_risk": scored("rain"),
    "heat_risk": scored("heat"),
    "wind_risk": scored("wind"),
    "uv_risk_direct": scored("uv"),
    "uv_risk_estimated": scored("uv", without=("UVI",)),
    "typhoon_risk": scored("typhoon"),
    "total_risk": total_risk,
    "score_all": score_all,
    "track_clean": track_clean,
    "track_hourly": track_hourly,
    "track_align": track_align,
    "interp_series": interp_series,
    "storm_distance": storm_distance,
    "storm_latest_announcement": storm_latest_announcement,
    "target_hours": target_hours,
    "storm_target_slots": storm_target_slots,
    "issue_time": issue_time,
    "target_slots": target_slots,
    "target_slots_semi": target_slots_semi,
    "target_slots_fallback": target_slots_fallback,
    "latest_base_asof": latest_base_asof,
    "uv_offsets": uv_offsets,
    "uv_asof_base": uv_asof_base,
    "uv_hourly": uv_hourly,
    "silver_build": silver_build,
    "silver_build_bucketed": silver_build_bucketed,
    "silver_backfill": silver_backfill,
    "silver_written": silver_written,
    "gold_written": gold_written,
    "gold_daily_written": gold_daily_written,
    "gold_latest": gold_latest,
    "gold_daily": gold_daily,
    "export_latest": export_latest,
    "export_daily": export_daily,
    "alert_rows": alert_rows,
    "alert_lines": alert_lines,
    "run_summary": run_summary,
    "feed_summary": feed_summary,
    "geojson_features": geojson_features,
    "bronze_nowcast": bronze_feed("ultra_nowcast"),
    "bronze_ultra": bronze_feed("ultra_shortfcst"),
    "bronze_short_fcst": bronze_feed("short_fcst", "PCP", "POP", "REH", "TMP", "WSD"),
    "bronze_uv": bronze_feed("uv"),
    "bronze_storm": bronze_feed("typhoon", "TY_DISTANCE_KM", "TY_MAX_WIND"),
    "bronze_counts": bronze_counts,
    "bronze_quarantine": bronze_quarantine,
    "bronze_to_gold": bronze_to_gold,
    "stream_bronze_ingest": stream_bronze_ingest,
    "stream_restarted": stream_restarted,
    "stream_quarantine": stream_quarantine,
    "stream_dedupe_items": stream_dedupe_items,
    "stream_append_newest": stream_append_newest,
    "stream_drop_repeats": stream_drop_repeats,
    "stream_daily_stats": stream_daily_stats,
    "gold_daily_incremental": gold_daily_incremental,
    "run_summary_observed": run_summary_observed,
    "silver_box": silver_box,
    "asof_polls": asof_polls,
    "latest_forecast_base": latest_forecast_base,
    "xml_items": xml_items,
    "csv_dimension": csv_dimension,
    "short_fcst_unique": short_fcst_unique,
    "runs_due": runs_due,
    "feed_sorted": feed_sorted,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, q=q: q(Tables(spark, sf_dir))) for name, q in QUERIES.items()}
