"""Feeds of a run to scored rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.functions.clock import forecast_clock
from galecast.functions.scores import WEIGHTS
from galecast.operators.canonical import canonicalize
from galecast.operators.coalesce import KEYS, Feed, merge_feeds
from galecast.operators.keys import KEY_HASH, newest_per_key
from galecast.operators.percentiles import RUN
from galecast.operators.regions import attach_regions
from galecast.operators.scoring import HAZARDS, Hazard, score_all
from galecast.operators.wide import nowcast_at_base_time
from galecast.sources.schemas import BASE_FEED
from galecast.sources.tables import RUN_COLUMN, bucketed, scan_feeds, stored, write_table

# What each feed may fill, in join order.
FILLS = {
    "ultra_nowcast": ("RN1", "REH", "T1H", "UUU", "VVV", "WSD", "PTY", "SKY", "VEC"),
    "short_fcst": ("PCP", "POP", "WSD"),
    "typhoon": ("TY_DISTANCE_KM", "TY_MAX_WIND", "TY_WARNING"),
    "uv": ("UVI", "UV_INDEX"),
}
NEWEST = ("baseDate", "baseTime")


def canonical_feeds(
    feeds: Mapping[str, DataFrame | None], nowcast_valid_time: str | None = None, read_amount_text: bool = False
) -> dict[str, DataFrame]:
    """The feeds that are there with canonical keys and numbers."""
    fixed = {
        n: canonicalize(df, read_amount_text=read_amount_text)
        for n, df in feeds.items()
        if df is not None
    }
    if nowcast_valid_time == "base" and "ultra_nowcast" in fixed:
        fixed["ultra_nowcast"] = nowcast_at_base_time(fixed["ultra_nowcast"])
    return fixed


def bucketed_feeds(
    feeds: Mapping[str, DataFrame | None],
    keys: Sequence[str] = KEYS,
    buckets: int = 200,
    order_by: Sequence[str] = NEWEST,
    nowcast_valid_time: str | None = None,
    read_amount_text: bool = False,
) -> dict[str, DataFrame]:
    """Canonical feeds with one row per key, each stored in ``buckets`` by the keys.

    ``build_silver(..., landed=True)`` merges them without a shuffle, however
    often it is run. A feed without the keys, such as a nowcast without a valid
    time, is left as it is and skipped by the merge.
    """
    out = {}
    for name, rows in canonical_feeds(feeds, nowcast_valid_time, read_amount_text).items():
        if set(keys) <= set(rows.columns):
            kept = rows.columns if name == BASE_FEED else [c for c in rows.columns if c in {*keys, *order_by, *FILLS[name]}]
            unique = newest_per_key(rows.select(*kept), keys, [c for c in order_by if c in kept], hashed=True)
            rows = bucketed(unique.drop(KEY_HASH), keys, buckets, f"feed_{name}")
        out[name] = rows
    return out


def merge(
    feeds: Mapping[str, DataFrame | None],
    keys: Sequence[str] = KEYS,
    order_by: Sequence[str] = NEWEST,
    nowcast_valid_time: str | None = None,
    read_amount_text: bool = False,
    landed: bool = False,
) -> DataFrame:
    """Canonical feeds joined onto the base feed, one row per key.

    The base is brought to one row per key before the joins rather than after:
    the right sides are unique per key, so the rows are the same, and a key that
    repeats often never reaches a join. ``landed`` says that the feeds are as
    ``bucketed_feeds`` left them.
    """
    if landed:
        base, fixed = feeds[BASE_FEED], feeds
    else:
        fixed = canonical_feeds(feeds, nowcast_valid_time, read_amount_text)
        base = fixed[BASE_FEED]
        base = newest_per_key(base, keys, [c for c in order_by if c in base.columns], hashed=True)
    rights = [Feed(n, fixed.get(n), columns, order_by) for n, columns in FILLS.items()]
    return merge_feeds(base, rights, keys, unique_base=True, unique_feeds=landed)


def build_silver(
    feeds: Mapping[str, DataFrame | None],
    regions: DataFrame | None,
    run_dt: str | None = None,
    order_by: Sequence[str] = NEWEST,
    hazards: Mapping[str, Hazard] = HAZARDS,
    weights: Mapping[str, float] = WEIGHTS,
    nowcast_valid_time: str | None = None,
    read_amount_text: bool = False,
    landed: bool = False,
) -> DataFrame:
    """Merged, labelled and scored rows of one run, or of all runs in the feeds.

    With ``run_dt`` the feeds are that run's. Without it they carry ``dt``
    themselves and any number of runs is built in one plan, each scored within
    its own run. ``landed`` feeds are as ``bucketed_feeds`` left them, by the
    keys and, without ``run_dt``, by ``dt``.

    The merged rows are stored: the numbers of the run are taken from them
    before they are scored, and so every feed is read and brought to one row per
    key once.
    """
    if run_dt is None:
        keys: Sequence[str] = (*KEYS, RUN_COLUMN)
    else:
        keys = KEYS
        feeds = {n: df.drop(RUN_COLUMN) for n, df in feeds.items() if df is not None}
    merged = stored(merge(feeds, keys, order_by, nowcast_valid_time, read_amount_text, landed), "merged")
    if run_dt is not None:
        merged = merged.withColumn(RUN_COLUMN, F.lit(run_dt))
    labelled = attach_regions(merged, regions)
    scored = score_all(labelled, hazards, weights, scope=RUN if run_dt is None else ())
    return scored.withColumns(
        {
            "fcst_ts": forecast_clock(F.col("fcstDate"), F.col("fcstTime")),
            "ingested_at": F.current_timestamp(),
        }
    )


def run_silver(
    spark: SparkSession, bronze: str, silver: str, regions: DataFrame | None,
    run_dt: str | Sequence[str], mode: str = "overwrite", table_format: str = "parquet", **options,
) -> None:
    """Build and write one run (a text) or backfill several (a list)."""
    single = run_dt if isinstance(run_dt, str) else None
    rows = build_silver(scan_feeds(spark, bronze, run_dt), regions, single, **options)
    write_table(rows, silver, [RUN_COLUMN], mode, table_format)
