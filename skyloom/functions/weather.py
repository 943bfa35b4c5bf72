"""Hourly weather measures and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyloom.constants import FOG_CODES, FREEZING_RAIN_CODES, THUNDERSTORM_CODES


def yes_no(test: Column) -> Column:
    """Oui / Non; an unknown test is Non."""
    return F.when(test, "Oui").otherwise("Non")


def wind_uv(speed: Column, direction: Column) -> Column:
    """``struct<u, v>`` of a wind that blows from ``direction`` degrees."""
    angle = F.radians(direction)
    return F.struct((-speed * F.sin(angle)).alias("u"), (-speed * F.cos(angle)).alias("v"))


def wind_shear(speed_low: Column, direction_low: Column, speed_high: Column, direction_high: Column) -> Column:
    """Length of the wind difference between two heights, 2 decimals; null if an input is."""
    low, high = wind_uv(speed_low, direction_low), wind_uv(speed_high, direction_high)
    return F.bround(
        F.sqrt(F.pow(high["u"] - low["u"], 2) + F.pow(high["v"] - low["v"], 2)), 2
    )


def fog(code: Column) -> Column:
    return yes_no(code.isin(*FOG_CODES))


def freezing_rain(code: Column) -> Column:
    return yes_no(code.isin(*FREEZING_RAIN_CODES))


def thunderstorms(code: Column) -> Column:
    return yes_no(code.isin(*THUNDERSTORM_CODES))


def has_precipitation(amount: Column) -> Column:
    return yes_no(F.coalesce(amount, F.lit(0.0)) > 0)


def icing(
    temperature: Column,
    humidity: Column,
    precipitation: Column,
    code: Column,
    dew_point: Column | None = None,
) -> Column:
    """Cold (2 degrees or less) and wet by any sign.

    The dew point counts as a sign only when given; tables that must agree with earlier ones
    leave it out.
    """
    wet = (
        F.coalesce(humidity >= 90, F.lit(False))
        | F.coalesce(precipitation > 0, F.lit(False))
        | F.coalesce(code.isin(*FOG_CODES, *FREEZING_RAIN_CODES), F.lit(False))
    )
    if dew_point is not None:
        wet = wet | F.coalesce(F.abs(temperature - dew_point) <= 1.0, F.lit(False))
    return yes_no((temperature <= 2.0) & wet)
