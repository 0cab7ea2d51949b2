"""Landed responses of all services to the five bronze feeds and a quarantine.

A batch of responses is parsed once and stored once, under its own number: the
items of every service, what was refused, and what had no data, each in a part
of the ``landed`` table. The feeds of the runs that the batch touches are then
built from what is stored of these runs, and replace what was there. So a batch
that is run again changes nothing, responses of a run may come in several
batches, and no response is lost: every one is in exactly one part.

All runs of a batch are built in one plan: what follows from the time of a poll
(bases to look back to, target hours) is worked out once a run and joined to the
items by the run column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galecast.functions.clock import compact_clock, floor_hour, forecast_base, issue_time, nowcast_base, plus_hours, time_text
from galecast.operators import storm, uv, wide
from galecast.operators.asof import latest_base
from galecast.operators.slots import HORIZON_HOURS, keep_hours_or_fallback
from galecast.sources.responses import fill_cells, parse_items
from galecast.sources.schemas import FEEDS, ITEM, TRACK_ITEM
from galecast.sources.tables import RUN_COLUMN, land_feed, write_table

LANDED = "landed"
QUARANTINE, NO_DATA = "quarantine", "no_data"
ASKED = ("service", RUN_COLUMN, "nx", "ny", "area", "asked", "seq")
STORED = (
    "service string, nx int, ny int, area string, asked string, seq long, status string, text string, pos int, "
    "item map<string,string>, dt string, batch long, part string"
)


def landed_responses(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """A stream of landed files ``service=<s>/dt=<run>/.../<file>`` with what was asked, from their paths.

    ``nx=``, ``ny=``, ``area=`` and ``asked=`` (the base hour asked for) are
    read where they are part of the path. Later files come later in ``seq``.
    """
    texts = spark.readStream.option("wholetext", True).option("recursiveFileLookup", True)
    texts = texts.option("maxFilesPerTrigger", files_per_batch).text(path)

    def part(name: str) -> Column:
        return F.nullif(F.regexp_extract("_metadata.file_path", rf"/{name}=([^/]*)/", 1), F.lit(""))

    return texts.select(
        F.unix_micros("_metadata.file_modification_time").alias("seq"), F.col("value").alias("text"),
        *[part(n).alias(n) for n in ("service", RUN_COLUMN, "area", "asked")], *[part(n).try_cast("int").alias(n) for n in ("nx", "ny")],
    )


def parsed(responses: DataFrame) -> DataFrame:
    """Items of all services in one parse, and the part of the table each row belongs to."""
    rows = parse_items(responses, keep=ASKED, xml=F.col("service") == "uv")
    part = (
        F.when(F.col("status") == "no_data", NO_DATA)
        .when((F.col("status") == "good") & F.col("service").isin(*FEEDS), F.col("service"))
        .otherwise(QUARANTINE)
    )
    return rows.withColumn("part", part)


def store_batch(responses: DataFrame, number: int, root: str) -> list[str]:
    """Store a batch of responses; returns the runs it touches. Stored again, it replaces itself."""
    rows = parsed(responses).withColumn("batch", F.lit(number).cast("long"))
    write_table(rows, f"{root}/{LANDED}", [RUN_COLUMN, "batch", "part"])
    stored = read_landed(responses.sparkSession, root).where(F.col("batch") == number)
    return [r[0] for r in stored.select(RUN_COLUMN).distinct().orderBy(RUN_COLUMN).collect()]  # a row a run


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(f"{root}/{LANDED}")


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """The refused responses with their text and status."""
    return read_landed(spark, root).where(F.col("part") == QUARANTINE).drop("pos", "item", "part")


def poll_clock() -> Column:
    """The time of a poll: the hour of its run."""
    return compact_clock(F.concat(F.col(RUN_COLUMN), F.lit("00")))


def poll_times(spark: SparkSession, runs: Sequence[str]) -> DataFrame:
    """One row per run with what follows from the time of its poll.

    ``_nowcast`` and ``_forecast`` are the newest published bases, ``_start`` and
    ``_after_issue`` the first hour wanted of the short-range forecast and the
    one after its issue. As expressions of the rows themselves they would be
    worked out anew in every filter of every item.
    """
    asked = spark.range(1, numPartitions=1).select(F.explode(F.array(*[F.lit(r) for r in dict.fromkeys(runs)])).alias(RUN_COLUMN))
    after_issue = plus_hours(issue_time(poll_clock()), 1)
    return asked.select(
        RUN_COLUMN, nowcast_base(poll_clock()).alias("_nowcast"), forecast_base(poll_clock()).alias("_forecast"),
        F.greatest(after_issue, floor_hour(poll_clock())).alias("_start"), after_issue.alias("_after_issue"),
    )


def _fields(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Named values of the item maps; ``order`` says which item came later."""
    return rows.select(
        RUN_COLUMN, F.struct("seq", "pos").alias("order"), F.col("nx").alias("_nx"), F.col("ny").alias("_ny"), "area", "asked", "item",
        *[F.try_element_at("item", F.lit(n)).alias(n) for n in names],
    )


def _cell_items(rows: DataFrame, part: str) -> DataFrame:
    items = _fields(rows.where(F.col("part") == part), ITEM.fieldNames())
    filled = fill_cells(items, F.col("_nx"), F.col("_ny")).drop("_nx", "_ny", "area", "asked", "item")
    return filled.withColumns({c: time_text(F.col(c)) for c in ("fcstTime", "baseTime")})


def _polled(items: DataFrame, polls: DataFrame, *times: str) -> DataFrame:
    """Items with the named times of their poll; a run has one row in ``polls``."""
    return items.join(F.broadcast(polls.select(RUN_COLUMN, *times)), RUN_COLUMN)


def nowcast_feed(rows: DataFrame, polls: DataFrame) -> DataFrame:
    """The newest published nowcast of every run and cell, looking back over a few bases."""
    items = _polled(_cell_items(rows, "ultra_nowcast"), polls, "_nowcast")
    items = latest_base(items, F.col("_nowcast"), keys=(RUN_COLUMN, "nx", "ny"))
    return wide.latest_wide(items.drop("fcstDate", "fcstTime", "fcstValue"), wide.NOWCAST_CATEGORIES, "order", [RUN_COLUMN])


def ultra_feed(rows: DataFrame, polls: DataFrame) -> DataFrame:
    """The newest published ultra-short forecast of every run and cell."""
    items = _polled(_cell_items(rows, "ultra_shortfcst"), polls, "_forecast")
    items = latest_base(items, F.col("_forecast"), keys=(RUN_COLUMN, "nx", "ny"))
    return wide.latest_wide(items.drop("obsrValue"), wide.ULTRA_CATEGORIES, "order", [RUN_COLUMN])


def short_feed(rows: DataFrame, calls: DataFrame, polls: DataFrame, horizon: int = HORIZON_HOURS) -> DataFrame:
    """The next hours of the short-range forecast; cells without them take the hours after the issue."""
    items = _cell_items(rows, "short_fcst").where(F.col("category").isin(*wide.SHORT_CATEGORIES))
    items = _polled(items, polls, "_start", "_after_issue")
    kept = keep_hours_or_fallback(items, F.col("_start"), F.col("_after_issue"), horizon, (RUN_COLUMN, "nx", "ny"))
    coded = wide.with_region_code(wide.short_forecast_wide(kept, by=[RUN_COLUMN]), calls)
    return wide.unique_short_forecast(coded, [RUN_COLUMN])


def run_hours(ultra: DataFrame, runs: DataFrame, horizon: int = HORIZON_HOURS) -> DataFrame:
    """run, ts: the newest ``horizon`` times of each run's ultra-short feed, cut to the hour; else the hour of the poll."""
    times = ultra.select(RUN_COLUMN, compact_clock(F.concat("fcstDate", time_text(F.col("fcstTime")))).alias("ts")).where("ts is not null").distinct()
    newest = Window.partitionBy(RUN_COLUMN).orderBy(F.desc("ts"))  # the distinct hours of one run
    kept = times.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= horizon)
    kept = kept.select(RUN_COLUMN, floor_hour(F.col("ts")).alias("ts")).distinct()
    return runs.join(kept, RUN_COLUMN, "left").select(RUN_COLUMN, F.coalesce("ts", floor_hour(poll_clock())).alias("ts"))


def index_feed(rows: DataFrame, calls: DataFrame, hours: DataFrame) -> DataFrame:
    """The UV index of every run, area and target hour, from the newest base that has values."""
    items = _fields(rows.where(F.col("part") == "uv"), []).select(
        RUN_COLUMN, "order", F.col("area").alias("admin_code"), compact_clock(F.concat("asked", F.lit("00"))).alias("base_ts"), "item"
    )
    return uv.uv_feed_of_runs(items, calls, hours, RUN_COLUMN, "order")


def track_feed(rows: DataFrame, grid: DataFrame | None, hours: DataFrame, window: int = HORIZON_HOURS) -> DataFrame:
    """Distance of every cell to the track of its run, for ``window`` hours up to the newest target; empty without a grid."""
    if grid is None:
        return storm.empty_storm_feed(rows.sparkSession).withColumn(RUN_COLUMN, F.lit(None).cast("string"))
    items = _fields(rows.where(F.col("part") == "typhoon"), TRACK_ITEM.fieldNames())
    track = storm.clean_track(items, keep=(RUN_COLUMN, "order"))
    ends = hours.groupBy(RUN_COLUMN).agg(F.max("ts").alias("end"))
    steps = F.explode(F.sequence(plus_hours(F.col("end"), 1 - window), F.col("end"), F.expr("INTERVAL 1 HOUR")))
    return storm.storm_feed_of_runs(grid, track, ends.select(RUN_COLUMN, steps.alias("ts")), RUN_COLUMN, ["order"])


def build_runs(
    spark: SparkSession, root: str, runs: Sequence[str], calls: DataFrame, grid: DataFrame | None,
    feeds: Sequence[str] = tuple(FEEDS),
) -> None:
    """Build the feeds of ``runs`` from what is stored of them and put them under their runs, replacing what was there."""
    if not runs:
        return
    rows = read_landed(spark, root).where(F.col(RUN_COLUMN).isin(*runs))
    polls = poll_times(spark, runs)
    if {"ultra_shortfcst", "uv", "typhoon"} & set(feeds):
        land_feed(ultra_feed(rows, polls), root, "ultra_shortfcst")
    if "ultra_nowcast" in feeds:
        land_feed(nowcast_feed(rows, polls), root, "ultra_nowcast")
    if "short_fcst" in feeds:
        land_feed(short_feed(rows, calls, polls), root, "short_fcst")
    if not {"uv", "typhoon"} & set(feeds):
        return
    ultra = spark.read.schema("fcstDate string, fcstTime string, dt string").parquet(f"{root}/ultra_shortfcst")
    hours = run_hours(ultra.where(F.col(RUN_COLUMN).isin(*runs)), polls.select(RUN_COLUMN))
    if "uv" in feeds:
        land_feed(index_feed(rows, calls, hours), root, "uv")
    if "typhoon" in feeds:
        land_feed(track_feed(rows, grid, hours), root, "typhoon")


def add_batch(
    batch: DataFrame, number: int, root: str, calls: DataFrame, grid: DataFrame | None, feeds: Sequence[str] = tuple(FEEDS)
) -> None:
    """Store a batch and build the runs it touches."""
    build_runs(batch.sparkSession, root, store_batch(batch, number, root), calls, grid, feeds)


def collect(
    responses: DataFrame, root: str, checkpoint: str, calls: DataFrame, grid: DataFrame | None,
    feeds: Sequence[str] = tuple(FEEDS), once: bool = True,
) -> StreamingQuery:
    """The polling loop as a stream over landed responses (columns ``ASKED`` and ``text``)."""
    writer = responses.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: add_batch(batch, number, root, calls, grid, feeds)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
