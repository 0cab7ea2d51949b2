"""Storm tracks and the distance of every cell to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galecast.functions.clock import YEAR_RANGE, any_clock
from galecast.functions.geo import distance_km
from galecast.functions.numeric import as_number
from galecast.operators.keys import newest_per_key
from galecast.operators.series import interpolate, interpolate_on_hours, resample_hourly
from galecast.operators.slots import slot_columns

# Names under which the parts of a track may come.
LATITUDE = ("typLat", "lat", "latitude")
LONGITUDE = ("typLon", "lon", "longitude")
TIME = ("fcstTime", "typTm", "tm", "tmFc")
WIND = ("typWs", "ws", "wind", "maxWind")
ANNOUNCED = ("tmFc", "announceTime")
SEQUENCE = ("typSeq", "typhoonSeq", "tmSeq")
TRACK_VALUES = ("lat", "lon", "wind")

STORM_SCHEMA = T.StructType(
    [
        T.StructField("nx", T.IntegerType()),
        T.StructField("ny", T.IntegerType()),
        T.StructField("fcstDate", T.StringType()),
        T.StructField("fcstTime", T.StringType()),
        T.StructField("TY_DISTANCE_KM", T.DoubleType()),
        T.StructField("TY_MAX_WIND", T.DoubleType()),
        T.StructField("TY_WARNING", T.DoubleType()),
    ]
)


def first_of(df: DataFrame, names: Sequence[str], kind: str = "string") -> Column:
    """First non-null value of a row among the columns that are there."""
    found = [F.col(n).cast(kind) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast(kind)


def clean_track(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Track items to ``time, lat, lon, wind``, readable positions of sensible years only.

    Times that are not ``yyyyMMddHHmm`` are read as a date-time text. ``keep``
    names columns to carry along (a storm, an order).
    """
    time = any_clock(first_of(items, TIME))
    coordinates = {}
    for name, names in (("lat", LATITUDE), ("lon", LONGITUDE), ("wind", WIND)):
        found = [as_number(items, n) for n in names if n in items.columns]
        coordinates[name] = F.coalesce(*found) if found else F.lit(None).cast("double")
    track = items.select(*keep, time.alias("time"), *[c.alias(n) for n, c in coordinates.items()])
    return track.where(
        F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
        & F.year("time").between(*YEAR_RANGE)
    )


def latest_announcement(items: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Newest full announcement time (12 digits) per group, as text; null if none is full."""
    text = F.btrim(first_of(items, ANNOUNCED))
    # As numbers, so that the maximum is kept in fixed width while aggregating.
    full = F.when(text.rlike(r"^\d{12}$"), text.try_cast("long"))
    newest = items.select(*by, full.alias("tmFc")).groupBy(*by).agg(F.max("tmFc").alias("tmFc"))
    return newest.withColumn("tmFc", F.lpad(F.col("tmFc").cast("string"), 12, "0"))


def one_point_per_time(
    track: DataFrame, series: Sequence[str] = (), order_by: Sequence[str] = ()
) -> DataFrame:
    """The newest point of every time of a series; repeated times cannot be interpolated."""
    kept = newest_per_key(track, [*series, "time"], order_by)
    return kept.select(*series, "time", *TRACK_VALUES)


def hourly_track(track: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    return resample_hourly(track, series, TRACK_VALUES)


def align_track(hourly: DataFrame, targets: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Positions at the target times; the end values hold outside the track."""
    return interpolate(hourly, targets, series, TRACK_VALUES)


def positions_at(points: DataFrame, targets: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """``align_track(hourly_track(points), targets)``, looking up only the hours next to the targets."""
    return interpolate_on_hours(points, targets, series, TRACK_VALUES)


def storm_feed(grid: DataFrame, positions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per cell and hour: distance, wind and warning flag; null without a position.

    ``positions`` has one row per target hour (``time``), so its list is bounded
    by the calendar (a year of hours is under 0.5 MB), times the runs where
    ``by`` names them. It goes to the cells as one value, and the cells are read
    once, without a shuffle.
    """
    listed = positions.agg(F.array_sort(F.collect_list(F.struct(*by, "time", *TRACK_VALUES)))).scalar()
    placed = grid.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        F.col("nx").cast("int").alias("nx"),
        F.col("ny").cast("int").alias("ny"),
        F.col("lat").alias("_lat"),
        F.col("lon").alias("_lon"),
        F.explode(listed).alias("p"),
    )
    known = F.col("p.lat").isNotNull() & F.col("p.lon").isNotNull()
    distance = distance_km(F.col("_lat"), F.col("_lon"), F.col("p.lat"), F.col("p.lon"))
    return placed.select(
        *[F.col("p").getField(c).alias(c) for c in by], "nx", "ny",
        *[c.alias(n) for n, c in slot_columns(F.col("p.time")).items()],
        F.when(known, distance).alias("TY_DISTANCE_KM"),
        F.when(known, F.col("p.wind")).alias("TY_MAX_WIND"),
        F.when(known, F.lit(0.0)).alias("TY_WARNING"),
    )


def empty_storm_feed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STORM_SCHEMA)


def storm_feed_of_runs(
    grid: DataFrame, track: DataFrame, targets: DataFrame, run: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """The storm feed of many runs in one plan; ``track`` and ``targets`` (``run``, ``ts``) carry their run."""
    points = one_point_per_time(track, [run], order_by)
    positions = positions_at(points, targets.select(run, F.col("ts").alias("time")).distinct(), [run])
    return storm_feed(grid, positions, [run])


def build_storm_feed(
    grid: DataFrame | None, track: DataFrame, targets: DataFrame, order_by: Sequence[str] = ()
) -> DataFrame:
    """Track points (all storms form one track) and target hours (``ts``) to the storm feed."""
    if grid is None:
        return empty_storm_feed(track.sparkSession)
    positions = positions_at(one_point_per_time(track, (), order_by), targets.select(F.col("ts").alias("time")).distinct())
    return storm_feed(grid, positions)
