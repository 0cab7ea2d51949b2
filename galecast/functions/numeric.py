"""Tolerant numbers and the small curves the hazard scores are made of."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted as a number. Stricter than a Spark cast, which would also
# take type suffixes such as "1.5d".
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Blanks removed around a text before it is read.
BLANKS = " \t\r\n\f\u000b"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def number_from_text(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    t = stripped(text)
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def as_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double without NaN; a missing column is all null."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return number_from_text(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(F.col(name).cast("double"))
    return F.col(name).try_cast("double")


def bound(value: Column, low: float, high: float) -> Column:
    """Clip a value that is known not to be null (null would become a bound)."""
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))


def clip(value: Column, low: float, high: float) -> Column:
    """Clip that keeps null."""
    return F.when(value.isNotNull(), bound(value, low, high))


def smoothstep(value: Column) -> Column:
    x = bound(value, 0.0, 1.0)
    return x * x * (3.0 - 2.0 * x)


def logistic(value: Column, k: float, x0: float) -> Column:
    return 1.0 / (1.0 + F.exp(-k * (value - x0)))


def logistic_at(value: float, k: float, x0: float) -> float:
    """The same curve for a constant, folded before the plan is made."""
    return 1.0 / (1.0 + math.exp(-k * (value - x0)))


def exp_rise(value: Column, scale: float, power: float = 1.0) -> Column:
    """0 at 0 and below, rising to 1; ``value`` must not be null."""
    x = F.greatest(value, F.lit(0.0)) / max(float(scale), 1e-9)
    return 1.0 - F.exp(-(x if power == 1.0 else F.pow(x, F.lit(float(power)))))


def piecewise_linear(value: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Linear between the anchors, constant outside; ``value`` must not be null."""
    curve = F.when(value <= xs[0], F.lit(float(ys[0])))
    for x0, x1, y0, y1 in zip(xs, xs[1:], ys, ys[1:]):
        curve = curve.when(value <= x1, y0 + (value - x0) * ((y1 - y0) / (x1 - x0)))
    return curve.otherwise(F.lit(float(ys[-1])))


def variants(df: DataFrame, name: str) -> list[str]:
    """``name`` and its suffixed copies (``WSD``, ``WSD_nc``, ...)."""
    return [c for c in df.columns if c == name or c.startswith(name + "_")]


def row_max(columns: Sequence[Column]) -> Column:
    """Largest non-null value of a row."""
    if not columns:
        return F.lit(None).cast("double")
    return columns[0] if len(columns) == 1 else F.greatest(*columns)


def pick_number(df: DataFrame, names: Sequence[str]) -> Column:
    """Row maximum over the columns ``names`` and their suffixed copies."""
    found = dict.fromkeys(c for n in names for c in variants(df, n))
    return row_max([as_number(df, c) for c in found])
