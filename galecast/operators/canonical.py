"""Canonical keys and numbers of the wide feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galecast.functions.clock import date_text, time_text
from galecast.functions.numeric import as_number, nan_to_null
from galecast.functions.precip import mm_search

# Columns that are numbers in every feed.
NUMBER_COLUMNS = (
    "RN1", "PCP", "POP", "WSD", "WGS", "GUST", "UUU", "VVV",
    "T1H", "TMP", "REH", "PTY", "SKY", "UVI", "UV_INDEX",
    "TY_DISTANCE_KM", "TY_MAX_WIND", "TY_WARNING",
)
AMOUNT_COLUMNS = ("RN1", "PCP")


def canonicalize(
    df: DataFrame, numbers: Sequence[str] = NUMBER_COLUMNS, read_amount_text: bool = False
) -> DataFrame:
    """Whole-number cells, dates without dashes, four-digit times, numbers as doubles.

    Text that is not a number becomes null. With ``read_amount_text`` the
    amounts written as words or ranges are read instead of being lost.
    """

    def fixed(name: str):
        c = F.col(name)
        if name in ("nx", "ny"):
            return as_number(df, name).try_cast("int")
        if name in ("fcstDate", "baseDate"):
            return date_text(c)
        if name in ("fcstTime", "baseTime"):
            return time_text(c)
        if name in numbers:
            if read_amount_text and name in AMOUNT_COLUMNS and isinstance(
                df.schema[name].dataType, T.StringType
            ):
                return F.when(c.isNotNull(), mm_search(c))
            return nan_to_null(c.try_cast("double"))
        return c

    return df.select(*[fixed(c).alias(c) for c in df.columns])
