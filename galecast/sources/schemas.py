"""Declared schemas of the feeds.

The feeds may lack columns from one run to the next; read under a declared
schema, a missing column is a typed null and the plan is known before any file
is opened, which a stream needs.
"""

from __future__ import annotations

from pyspark.sql import types as T

from galecast.operators.storm import STORM_SCHEMA
from galecast.operators.wide import NOWCAST_CATEGORIES, SHORT_CATEGORIES, ULTRA_CATEGORIES


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


_CELL = _fields(T.IntegerType(), "nx", "ny")
_VALID = _fields(T.StringType(), "fcstDate", "fcstTime")
_BASE = _fields(T.StringType(), "baseDate", "baseTime")

# One item of a response; every value is text until it is canonicalised.
ITEM = T.StructType(
    _fields(
        T.StringType(),
        "nx", "ny", "baseDate", "baseTime", "fcstDate", "fcstTime",
        "category", "fcstValue", "obsrValue",
    )
)
TRACK_ITEM = T.StructType(
    _fields(
        T.StringType(),
        "typLat", "lat", "latitude", "typLon", "lon", "longitude",
        "fcstTime", "typTm", "tm", "tmFc", "announceTime",
        "typWs", "ws", "wind", "maxWind", "typSeq", "typhoonSeq", "tmSeq",
    )
)

ULTRA_SHORT = T.StructType(_CELL + _VALID + _BASE + _fields(T.StringType(), *ULTRA_CATEGORIES))
NOWCAST = T.StructType(_CELL + _BASE + _fields(T.StringType(), *NOWCAST_CATEGORIES))
SHORT = T.StructType(
    _fields(T.LongType(), "admin_code")
    + _CELL
    + _VALID
    + _fields(T.TimestampType(), "valid_ts_kst")
    + [
        T.StructField(c, T.IntegerType() if c in ("PTY", "SKY") else T.DoubleType())
        for c in sorted(SHORT_CATEGORIES)
    ]
)
UV = T.StructType(_CELL + _VALID + _fields(T.IntegerType(), "UVI"))

REGIONS = T.StructType(
    _fields(T.StringType(), "admin_code", "admin_name")
    + _fields(T.DoubleType(), "lat", "lon")
    + _CELL
    + _fields(T.StringType(), "SIG_CD")
)

GRID = T.StructType(_CELL + _fields(T.DoubleType(), "lat", "lon"))

# Feed names, as they appear in paths.
BASE_FEED = "ultra_shortfcst"
FEEDS = {
    "ultra_shortfcst": ULTRA_SHORT,
    "ultra_nowcast": NOWCAST,
    "short_fcst": SHORT,
    "typhoon": STORM_SCHEMA,
    "uv": UV,
}
