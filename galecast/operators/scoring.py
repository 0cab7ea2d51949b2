"""Scores of a whole table.

The scores are row-local except for three numbers of the run a row belongs to:
the percentiles of storm wind, those of temperature (only where the UV index is
estimated), and whether the run has any ``T1H`` at all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.functions import scores as S
from galecast.functions.numeric import as_number, pick_number, variants
from galecast.functions.precip import mm_column, pick_mm
from galecast.operators.percentiles import RUN, join_scope, scope_statistics

UV_COLUMNS = ("UVI", "UV_INDEX", "UV")
STORM_COLUMNS = ("TY_DISTANCE_KM", "TY_MAX_WIND", "TY_WARNING")

Columns = Mapping[str, Column]


def _nothing(df: DataFrame) -> Columns:
    return {}


@dataclass(frozen=True)
class Statistics:
    """Numbers of the run: per name the values whose low and high percentile count, and what any row may show.

    They come as ``_<name>_low`` and ``_<name>_high``, and as ``_<flag>`` (true or null).
    """

    percentiles: Columns = field(default_factory=dict)
    flags: Columns = field(default_factory=dict)


def _no_statistics(df: DataFrame) -> Statistics:
    return Statistics()


@dataclass(frozen=True)
class Hazard:
    """How one hazard is scored.

    ``inputs`` reads what the score needs from the table; it is worked out once
    per row, as columns of their own. ``score`` is made of those columns.
    ``statistics`` names the numbers of the run it needs; those of all hazards
    are taken in one pass.
    """

    score: Callable[[Columns], Column]
    inputs: Callable[[DataFrame], Columns] = _nothing
    statistics: Callable[[DataFrame], Statistics] = _no_statistics


# ---- rain ------------------------------------------------------------------


def _amount(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return mm_column(df, name)
    return F.coalesce(pick_mm(df, [name]), F.lit(0.0))


def _rain_inputs(df: DataFrame) -> Columns:
    return {
        "rate": _amount(df, "RN1"), "amount": _amount(df, "PCP"), "chance": pick_number(df, ["POP"])
    }


def rain_hazard(settings: S.RainSettings = S.RainSettings()) -> Hazard:
    return Hazard(
        lambda c: S.rain_score(c["rate"], c["amount"], c["chance"], settings), _rain_inputs
    )


# ---- heat ------------------------------------------------------------------


def _heat_inputs(df: DataFrame) -> Columns:
    temperature = as_number(df, "T1H")
    if "T1H" not in df.columns:
        temperature = as_number(df, "TMP")
    elif "_has_t1h" in df.columns:
        temperature = F.when(F.col("_has_t1h"), temperature).otherwise(as_number(df, "TMP"))
    return {
        "temperature": temperature, "humidity": as_number(df, "REH"), "wind": as_number(df, "WSD")
    }


def _heat_statistics(df: DataFrame) -> Statistics:
    """Whether the run has any T1H; TMP stands in only where it has none, or where there is no such column."""
    if not {"T1H", "TMP"} <= set(df.columns):
        return Statistics()
    return Statistics(flags={"has_t1h": as_number(df, "T1H").isNotNull()})


# ---- wind ------------------------------------------------------------------


def _wind_inputs(df: DataFrame) -> Columns:
    speed = pick_number(df, ["WSD"])
    if {"UUU", "VVV"} <= set(df.columns):
        speed = S.wind_speed(speed, as_number(df, "UUU"), as_number(df, "VVV"))
    return {"speed": speed}


# ---- UV --------------------------------------------------------------------


def uv_column(df: DataFrame) -> str | None:
    """The index column of the table; without one the index is estimated."""
    return next((c for c in UV_COLUMNS if c in df.columns), None)


def _uv_inputs(df: DataFrame) -> Columns:
    given = uv_column(df)
    if given:
        return {"index": as_number(df, given)}
    hour = F.substring(F.col("fcstTime").cast("string"), 1, 2).try_cast("int")
    damping = S.rain_dampening(
        pick_mm(df, ["PCP"]) if variants(df, "PCP") else None,
        pick_number(df, ["POP"]) if variants(df, "POP") else None,
    )
    return {
        "sky": pick_number(df, ["SKY"]),
        "warmth": S.percentile_scale(
            pick_number(df, ["T1H", "TMP"]), F.col("_warm_low"), F.col("_warm_high")
        ),
        "daylight": S.daylight_factor(F.coalesce(hour, F.lit(S.UV_DEFAULTS["hour"]))),
        "damping": damping,
    }


def _uv_score(c: Columns) -> Column:
    if "index" in c:
        return S.uv_score(c["index"])
    return S.uv_estimate_score(c["sky"], c["warmth"], c["daylight"], c["damping"])


def _uv_statistics(df: DataFrame) -> Statistics:
    if uv_column(df):
        return Statistics()
    return Statistics(percentiles={"warm": pick_number(df, ["T1H", "TMP"])})


# ---- storm -----------------------------------------------------------------


def _has_storm(df: DataFrame) -> bool:
    return bool(set(STORM_COLUMNS) & set(df.columns))


def _storm_inputs(df: DataFrame) -> Columns:
    if not _has_storm(df):
        return {}
    return {
        "distance": as_number(df, "TY_DISTANCE_KM"),
        "strength": S.percentile_scale(
            as_number(df, "TY_MAX_WIND"), F.col("_storm_low"), F.col("_storm_high")
        ),
        "warning": as_number(df, "TY_WARNING"),
    }


def _storm_score(c: Columns) -> Column:
    if not c:
        return F.lit(0.0)
    return S.storm_score(c["distance"], c["strength"], c["warning"])


def _storm_statistics(df: DataFrame) -> Statistics:
    if not _has_storm(df):
        return Statistics()
    return Statistics(percentiles={"storm": as_number(df, "TY_MAX_WIND")})


HAZARDS: Mapping[str, Hazard] = {
    "rain": rain_hazard(),
    "heat": Hazard(
        lambda c: S.heat_score(c["temperature"], c["humidity"], c["wind"]),
        _heat_inputs,
        _heat_statistics,
    ),
    "wind": Hazard(lambda c: S.wind_score(c["speed"]), _wind_inputs),
    "uv": Hazard(_uv_score, _uv_inputs, _uv_statistics),
    "typhoon": Hazard(_storm_score, _storm_inputs, _storm_statistics),
}


def prepare(
    df: DataFrame, hazards: Mapping[str, Hazard], scope: Sequence[str] = RUN
) -> tuple[DataFrame, dict[str, Columns]]:
    """The table with the run's numbers and the inputs of every hazard, and where they are."""
    measures, flags = [], {}
    for hazard in hazards.values():
        wanted = hazard.statistics(df)
        measures += [(v, S.NORMALISE_PERCENTILES, (f"_{n}_low", f"_{n}_high")) for n, v in wanted.percentiles.items()]
        flags |= {f"_{n}": c for n, c in wanted.flags.items()}
    ready = df
    if measures or flags:
        ready = join_scope(df, scope_statistics(df, scope, measures, flags), scope, few=True)
    places: dict[str, Columns] = {}
    added: dict[str, Column] = {}
    for name, hazard in hazards.items():
        inputs = hazard.inputs(ready)
        places[name] = {key: F.col(f"_{name}_in_{key}") for key in inputs}
        added.update({f"_{name}_in_{key}": column for key, column in inputs.items()})
    return (ready.withColumns(added) if added else ready), places


def add_scores(
    df: DataFrame, hazards: Mapping[str, Hazard] = HAZARDS, scope: Sequence[str] = RUN
) -> DataFrame:
    """The input with one ``R_<hazard>`` column per hazard."""
    ready, places = prepare(df, hazards, scope)
    scores = [hazard.score(places[name]).alias(f"R_{name}") for name, hazard in hazards.items()]
    return ready.select(*df.columns, *scores)


def score_all(
    df: DataFrame,
    hazards: Mapping[str, Hazard] = HAZARDS,
    weights: Mapping[str, float] = S.WEIGHTS,
    scope: Sequence[str] = RUN,
) -> DataFrame:
    """The input with all hazard scores and ``R_total``.

    A hazard of one's own is one more entry in ``hazards`` and its share in
    ``weights``.

    The total is written over the scores' own expressions. Spark then takes each
    score for a common subexpression, works it out once per row, and gives it a
    method of its own, which keeps the generated code within what the JVM
    optimises.
    """
    ready, places = prepare(df, hazards, scope)
    scores = {name: hazard.score(places[name]) for name, hazard in hazards.items()}
    return ready.select(
        *df.columns,
        *[score.alias(f"R_{name}") for name, score in scores.items()],
        S.total_score(scores, weights).alias("R_total"),
    )
