"""Precipitation amounts written as text, in the three dialects of the feeds.

Each reader turns one text column into millimetres. They differ on ranges,
on "less than" texts and on what an unreadable text means, so a feed must
keep the dialect it was scored with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galecast.functions.numeric import number_from_text, row_max, stripped, variants

# Words the feeds use inside amounts, and the patterns of amounts.
NO_RAIN = "강수없음"
NO_SNOW = "적설없음"
NONE = "없음"
BELOW = "미만"
BELOW_ONE_MM = "1mm 미만"
BELOW_ONE_SIGNS = ("<1", "<1mm")
MILLIMETRE_SIGN = "㎜"
NULL_WORDS = ("", "None", "nan")
BELOW_ONE_AMOUNT = 0.5
BELOW_FLOOR = 0.1
RANGE_PATTERN = r"^(\d+(?:\.\d+)?)~(\d+(?:\.\d+)?)$"
LIMIT_PATTERN = r"^(\d+(?:\.\d+)?)(미만|이상)$"
AMOUNT_PATTERN = r"(?i)(-?\d+(?:\.\d+)?)\s*mm"


def mm_range(text: Column) -> Column:
    """Ranges count as their middle, "below x" as half of x; unreadable is 0."""
    t = stripped(text)
    t = F.when(t.isin(NO_RAIN, "-", ""), F.lit("0")).otherwise(t)
    t = F.regexp_replace(F.replace(t, F.lit(MILLIMETRE_SIGN), F.lit("mm")), "mm| ", "")
    middle = (
        F.regexp_extract(t, RANGE_PATTERN, 1).try_cast("double")
        + F.regexp_extract(t, RANGE_PATTERN, 2).try_cast("double")
    ) / 2.0
    edge = F.regexp_extract(t, LIMIT_PATTERN, 1).try_cast("double") * F.when(
        F.endswith(t, F.lit(BELOW)), 0.5
    ).otherwise(1.0)
    return F.greatest(F.coalesce(number_from_text(t), middle, edge, F.lit(0.0)), F.lit(0.0))


def mm_search(text: Column, below_one: float = BELOW_ONE_AMOUNT) -> Column:
    """First amount followed by "mm" anywhere in the text; unreadable is 0."""
    t = stripped(text)
    sign, sign_mm = BELOW_ONE_SIGNS
    below = (
        F.contains(t, F.lit(BELOW_ONE_MM))
        | F.startswith(t, F.lit(sign))
        | F.contains(F.lower(t), F.lit(sign_mm))
    )
    amount = F.regexp_extract(t, AMOUNT_PATTERN, 1).try_cast("double")
    value = (
        F.when(F.contains(t, F.lit(NO_RAIN)), 0.0)
        .when(below, float(below_one))
        .otherwise(F.coalesce(amount, number_from_text(t), F.lit(0.0)))
    )
    return F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def mm_collector(text: Column) -> Column:
    """As amounts are read while collecting; unreadable is null."""
    t = stripped(text)
    digits = F.regexp_replace(t, r"[^0-9.]", "")
    below = F.when(digits == "", BELOW_ONE_AMOUNT).when(
        number_from_text(digits).isNotNull(),
        F.greatest(number_from_text(digits) * 0.5, F.lit(BELOW_FLOOR)),
    )
    return (
        F.when(t.isNull() | t.isin(*NULL_WORDS), None)
        .when(F.contains(t, F.lit(NONE)), 0.0)
        .when(F.contains(t, F.lit(BELOW)), below)
        .otherwise(number_from_text(F.replace(t, F.lit("mm"), F.lit(""))))
    )


def mm_column(df: DataFrame, name: str, reader=mm_search) -> Column:
    """Millimetres of one column; a numeric column only needs its sign checked."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return reader(F.col(name))
    value = F.nanvl(F.col(name).cast("double"), F.lit(0.0))
    return F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def pick_mm(df: DataFrame, names: Sequence[str]) -> Column:
    """Row maximum in millimetres over the columns ``names`` and their suffixed copies."""
    found = dict.fromkeys(c for n in names for c in variants(df, n))
    return row_max([mm_column(df, c, mm_range) for c in found])
