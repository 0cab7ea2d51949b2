"""Grid projection and great-circle distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lambert conformal conic grid of the feeds.
EARTH_RADIUS_KM = 6371.00877
CELL_KM = 5.0
STANDARD_LATITUDES = (30.0, 60.0)
ORIGIN_LONGITUDE = 126.0
ORIGIN_LATITUDE = 38.0
ORIGIN_X = 43
ORIGIN_Y = 136

# Fixed value: sphere used for distances.
DISTANCE_RADIUS_KM = 6371.0


def _half_angle(latitude_deg: float) -> float:
    return math.tan(math.pi / 4 + math.radians(latitude_deg) / 2)


_LOW, _HIGH = STANDARD_LATITUDES
CONE = math.log(math.cos(math.radians(_LOW)) / math.cos(math.radians(_HIGH))) / math.log(
    _half_angle(_HIGH) / _half_angle(_LOW)
)
RADIUS_SCALE = (
    EARTH_RADIUS_KM / CELL_KM * _half_angle(_LOW) ** CONE * math.cos(math.radians(_LOW)) / CONE
)
ORIGIN_RADIUS = RADIUS_SCALE / _half_angle(ORIGIN_LATITUDE) ** CONE


def grid_cell(latitude: Column, longitude: Column) -> tuple[Column, Column]:
    """Grid indexes of a point; halves are cut toward zero after adding 0.5."""
    radius = RADIUS_SCALE / F.pow(
        F.tan(math.pi / 4 + F.radians(latitude) / 2), F.lit(CONE)
    )
    turn = F.radians(longitude) - math.radians(ORIGIN_LONGITUDE)
    turn = (
        F.when(turn > math.pi, turn - 2 * math.pi)
        .when(turn < -math.pi, turn + 2 * math.pi)
        .otherwise(turn)
    ) * CONE
    x = radius * F.sin(turn) + ORIGIN_X
    y = ORIGIN_RADIUS - radius * F.cos(turn) + ORIGIN_Y
    return (x + 0.5).try_cast("int"), (y + 0.5).try_cast("int")


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    dlon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = dlat * dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * dlon * dlon
    return 2 * DISTANCE_RADIUS_KM * F.asin(F.sqrt(a))
