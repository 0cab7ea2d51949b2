"""Hazard scores as column expressions.

Every function takes columns and returns one double column. What depends on a
whole run (percentiles, "no value in the run") comes in as a column, so the
expressions stay row-local and inside code generation.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from galecast.functions.numeric import (
    bound,
    clip,
    exp_rise,
    logistic,
    logistic_at,
    piecewise_linear,
    smoothstep,
)

# ---- fixed values: they must be these for the scores to come out right ----
RAIN = {
    "rate_scale": 30.0, "rate_power": 0.95, "rate_share": 0.985,
    "downpour_from": 22.0, "downpour_scale": 16.0, "downpour_share": 0.12,
    "chance_power": 1.7, "chance_share_dry": 0.012, "chance_share_wet": 0.004,
    "amount_scale": 38.0, "amount_share": 0.03, "amount_gate_wet": 0.4,
    "dry_limit": 0.07, "wet_limit": 1.3, "curve_k": 3.2, "curve_x0": 0.56,
    "lowest": 0.010, "highest": 0.97, "dry_up_to": 0.2,
}

WEIGHTS = {"rain": 0.28, "heat": 0.18, "wind": 0.22, "uv": 0.12, "typhoon": 0.20}
PEAK_SHARE = 0.7
MEAN_SHARE = 0.3

HEAT_ANCHORS = (
    (16.0, 20.0, 24.0, 26.0, 28.0, 31.0, 34.0, 37.0, 40.0),
    (0.10, 0.16, 0.24, 0.30, 0.42, 0.60, 0.76, 0.88, 0.96),
)
HEAT_BOUNDS = (0.12, 0.96)
HEAT_DEFAULTS = {"temperature": 24.0, "humidity": 60.0, "wind": 1.5}
# (start, width) of a smooth step; shares of the three corrections.
MUGGY_SHARE, MUGGY_HUMIDITY, MUGGY_FROM, MUGGY_UP_TO = 0.020, (75.0, 20.0), (18.0, 5.0), (27.0, 2.0)
HUMID_SHARE, HUMID_FROM, HUMID_HEAT = 0.060, (60.0, 40.0), (31.5, 4.0)
BREEZE_SHARE, BREEZE_SCALE, BREEZE_FROM = 0.040, 10.0, (26.0, 4.0)

WIND_ANCHORS = (
    (0.0, 4.0, 8.0, 12.0, 16.0, 22.0, 30.0),
    (0.0, 0.02, 0.15, 0.45, 0.70, 0.90, 1.00),
)

UV_SCALE_MAX = 12.0
UV_CURVE, UV_ESTIMATE_CURVE = (5.0, 0.4), (5.0, 0.5)
UV_SHARES = {"sky": 0.45, "warmth": 0.35, "daylight": 0.20}
UV_DEFAULTS = {"sky": 3.0, "warmth": 0.5, "hour": 12}
CLOUDIEST, SKY_STEPS = 4.0, 3.0
DAYLIGHT = ((10, 15, 1.0), (8, 17, 0.7))
DAYLIGHT_ELSE = 0.3
WET_FACTOR, CHANCE_FACTOR = 0.4, 0.5

STORM_FLOOR = 0.010
STORM_REACH, STORM_EDGE, STORM_EDGE_WIDTH = 300.0, 700.0, 80.0
STORM_SHARES = {"near": 0.75, "force": 0.20, "alarm": 0.05}
STORM_POWERS = {"force": 1.2, "alarm": 1.5}
STORM_CURVE = (6.0, 0.35)
NORMALISE_PERCENTILES = (0.05, 0.95)

RISK_LEVELS = (("VERY_HIGH", 0.8), ("HIGH", 0.6), ("MED", 0.4))
LOWEST_LEVEL = "LOW"
# -------------------------------------------------------------------------


@dataclass(frozen=True)
class RainSettings:
    """Parameters of the rain score; amounts in millimetres."""

    rate_scale: float = RAIN["rate_scale"]
    rate_power: float = RAIN["rate_power"]
    rate_share: float = RAIN["rate_share"]
    downpour_from: float = RAIN["downpour_from"]
    downpour_scale: float = RAIN["downpour_scale"]
    downpour_share: float = RAIN["downpour_share"]
    chance_power: float = RAIN["chance_power"]
    chance_share_dry: float = RAIN["chance_share_dry"]
    chance_share_wet: float = RAIN["chance_share_wet"]
    amount_scale: float = RAIN["amount_scale"]
    amount_share: float = RAIN["amount_share"]
    amount_gate_wet: float = RAIN["amount_gate_wet"]
    dry_limit: float = RAIN["dry_limit"]
    wet_limit: float = RAIN["wet_limit"]
    curve_k: float = RAIN["curve_k"]
    curve_x0: float = RAIN["curve_x0"]
    lowest: float = RAIN["lowest"]
    highest: float = RAIN["highest"]
    dry_up_to: float = RAIN["dry_up_to"]


def rain_score(
    rate: Column, amount: Column, chance: Column, settings: RainSettings = RainSettings()
) -> Column:
    """``rate`` mm/h and ``amount`` mm (both non-null, >= 0), ``chance`` in percent."""
    s = settings
    dry = rate <= s.dry_up_to
    chance01 = bound(F.coalesce(chance, F.lit(0.0)), 0.0, 100.0) / 100.0
    extra = F.when(dry, s.chance_share_dry).otherwise(s.chance_share_wet) * F.pow(
        chance01, F.lit(s.chance_power)
    ) + s.amount_share * F.when(dry, 1.0).otherwise(s.amount_gate_wet) * exp_rise(
        amount, s.amount_scale
    )
    downpour = s.downpour_share * exp_rise(rate - s.downpour_from, s.downpour_scale)
    wet = s.rate_share * exp_rise(rate, s.rate_scale, s.rate_power) + downpour + extra
    base = F.when(dry, F.least(extra, F.lit(s.dry_limit))).otherwise(bound(wet, 0.0, s.wet_limit))
    at_zero = logistic_at(0.0, s.curve_k, s.curve_x0)
    at_one = logistic_at(1.0, s.curve_k, s.curve_x0)
    scaled = (logistic(base, s.curve_k, s.curve_x0) - at_zero) / (at_one - at_zero + 1e-9)
    return bound(F.coalesce(scaled, F.lit(s.lowest)), s.lowest, s.highest)


def heat_score(temperature: Column, humidity: Column, wind: Column) -> Column:
    """Degrees Celsius, percent, metres per second; nulls take the usual values."""
    t = F.coalesce(temperature, F.lit(HEAT_DEFAULTS["temperature"]))
    h = bound(F.coalesce(humidity, F.lit(HEAT_DEFAULTS["humidity"])), 0.0, 100.0)
    w = F.greatest(F.coalesce(wind, F.lit(HEAT_DEFAULTS["wind"])), F.lit(0.0))
    low, high = HEAT_BOUNDS
    line = piecewise_linear(t, *HEAT_ANCHORS)
    share = bound((line - low) / (high - low), 0.0, 1.0)
    middle = share * (1.0 - share)

    def step(value: Column, at: tuple[float, float]) -> Column:
        return smoothstep((value - at[0]) / at[1])

    muggy = MUGGY_SHARE * step(h, MUGGY_HUMIDITY) * step(t, MUGGY_FROM) * (1.0 - step(t, MUGGY_UP_TO)) * (1.0 - share)
    humid = bound((h - HUMID_FROM[0]) / HUMID_FROM[1], 0.0, 1.0)
    humid_heat = HUMID_SHARE * humid * step(t, HUMID_HEAT) * middle
    breeze = BREEZE_SHARE * (F.log1p(w) / F.log1p(F.lit(BREEZE_SCALE))) * step(t, BREEZE_FROM) * middle
    return bound(line + muggy + humid_heat - breeze, low, high)


def wind_speed(speed: Column, east: Column | None = None, north: Column | None = None) -> Column:
    """Larger of the reported speed and the length of the wind vector."""
    if east is None or north is None:
        return speed
    return F.greatest(speed, F.sqrt(east * east + north * north))


def wind_score(speed: Column) -> Column:
    return piecewise_linear(F.coalesce(speed, F.lit(0.0)), *WIND_ANCHORS)


def uv_score(index: Column) -> Column:
    """From a UV index; null scores 0."""
    return F.coalesce(logistic(clip(index / UV_SCALE_MAX, 0.0, 1.0), *UV_CURVE), F.lit(0.0))


def daylight_factor(hour: Column) -> Column:
    (first, last, full), (early, late, part) = DAYLIGHT
    return F.when(hour.between(first, last), full).when(hour.between(early, late), part).otherwise(DAYLIGHT_ELSE)


def uv_estimate_score(
    sky: Column, warmth: Column, daylight: Column, dampening: Column
) -> Column:
    """Without an index: ``sky`` code 1..4, ``warmth`` and ``daylight`` in 0..1,
    ``dampening`` the factor left by rain."""
    clear = (CLOUDIEST - F.coalesce(sky, F.lit(UV_DEFAULTS["sky"]))) / SKY_STEPS
    warm = F.coalesce(warmth, F.lit(UV_DEFAULTS["warmth"]))
    raw = (UV_SHARES["sky"] * clear + UV_SHARES["warmth"] * warm + UV_SHARES["daylight"] * daylight) * dampening
    return F.coalesce(logistic(clip(raw, 0.0, 1.0), *UV_ESTIMATE_CURVE), F.lit(0.0))


def rain_dampening(amount: Column | None, chance: Column | None) -> Column:
    """Factor by which rain lowers an estimated index; None for a feed without the column."""
    factor = F.lit(1.0)
    if amount is not None:
        factor = F.when(F.coalesce(amount, F.lit(0.0)) > 0, WET_FACTOR).otherwise(1.0)
    if chance is not None:
        share = bound(F.coalesce(chance, F.lit(0.0)) / 100.0, 0.0, 1.0)
        factor = factor * (1.0 - CHANCE_FACTOR * share)
    return factor


def percentile_scale(value: Column, low: Column, high: Column) -> Column:
    """Place of ``value`` between two percentiles of its run, 0..1.

    Null percentiles mean a run without any value: every row is 0. A run
    without spread tells only whether the value lies above it. An infinite value
    counts as missing.
    """
    value = F.when(F.abs(value) < float("inf"), value)
    spread = high - low
    flat = F.when(value > low, 1.0).otherwise(0.0)
    return (
        F.when(low.isNull(), 0.0)
        .when(F.abs(spread) < 1e-9, flat)
        .otherwise(clip((value - low) / (spread + 1e-6), 0.0, 1.0))
    )


def storm_score(distance: Column, strength: Column, warning: Column) -> Column:
    """``distance`` km, ``strength`` 0..1 within the run, ``warning`` flag."""
    # A null distance falls to the lower bound: no storm is near.
    reach = F.exp(-(distance / STORM_REACH))
    near = bound(reach * (1.0 / (1.0 + F.exp((distance - STORM_EDGE) / STORM_EDGE_WIDTH))), 0.0, 1.0)
    force = F.coalesce(strength, F.lit(0.0))
    alarm = bound(F.coalesce(warning, F.lit(0.0)), 0.0, 1.0)
    raw = bound(
        STORM_SHARES["near"] * near
        + STORM_SHARES["force"] * F.pow(near, F.lit(STORM_POWERS["force"])) * force
        + STORM_SHARES["alarm"] * F.pow(near, F.lit(STORM_POWERS["alarm"])) * alarm,
        0.0,
        1.0,
    )
    at_zero = logistic_at(0.0, *STORM_CURVE)
    scaled = bound((logistic(raw, *STORM_CURVE) - at_zero) / (1.0 - at_zero), 0.0, 1.0)
    return STORM_FLOOR + (1.0 - STORM_FLOOR) * scaled


def total_score(scores: Mapping[str, Column], weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Peak hazard and weighted mean in fixed shares."""
    columns = list(scores.values())
    peak = columns[0] if len(columns) == 1 else F.greatest(*columns)
    mean = reduce(add, [weights[name] * score for name, score in scores.items()])
    return clip(PEAK_SHARE * peak + MEAN_SHARE * clip(mean, 0.0, 1.0), 0.0, 1.0)


def risk_level(total: Column) -> Column:
    """Level of a total score; a null total is the lowest level."""
    level = None
    for name, least in RISK_LEVELS:
        level = F.when(total >= least, name) if level is None else level.when(total >= least, name)
    return level.otherwise(LOWEST_LEVEL)
