"""Scored rows as map features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ("nx", "ny")
CENTROID_COLUMNS = ("admin_code", "admin_name", "lat", "lon")
# Properties a feature may carry, in order.
PROPERTIES = (
    "admin_code", "admin_names", "R_total", "R_rain", "R_heat", "R_uv", "R_typhoon",
    "RN1", "PCP", "POP", "T1H", "TMP", "REH", "WSD", "PTY", "SKY",
    "baseDate", "baseTime", "fcstDate", "fcstTime",
)


def geojson_features(scored: DataFrame, regions: DataFrame) -> DataFrame:
    """One point feature per scored row and region of its cell, as a JSON text.

    Rows without a coordinate have no point and drop out. The texts form a
    newline-delimited GeoJSON file when written, in as many parts as there are
    tasks.
    """
    centroids = regions.select(*CELL, *[c for c in CENTROID_COLUMNS if c in regions.columns])
    placed = scored.join(centroids, list(CELL)).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct(*[c for c in PROPERTIES if c in placed.columns]).alias("properties"),
    )
    return placed.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def write_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").text(path)
