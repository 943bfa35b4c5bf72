"""Missing values, labels, ratios and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.constants import (
    LATE_AFTER_MINUTES,
    MISSING_DELAY_WORDS,
    RISK_HIGH_FROM,
    RISK_MEDIUM_FROM,
)


def filled(c: Column) -> Column:
    """A text, with empty text read as missing."""
    return F.nullif(c, F.lit(""))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[filled(c) for c in columns])


def null_for_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def number(c: Column) -> Column:
    """Any column as a number; unreadable values and NaN are missing."""
    return null_for_nan(c.try_cast("double"))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes null: missing has one form only."""
    real = [n for n, k in df.dtypes if k in ("double", "float")]
    return df.withColumns({n: null_for_nan(F.col(f"`{n}`")) for n in real}) if real else df


def arrival_delay(arrival: Column, departure: Column) -> Column:
    """Arrival delay, else departure delay; words for "missing" count as missing."""
    missing = arrival.isNull() | F.lower(arrival.cast("string")).isin(*MISSING_DELAY_WORDS)
    return F.when(missing, departure).otherwise(arrival)


def late_label(delay: Column, after: float = LATE_AFTER_MINUTES) -> Column:
    """1 when the delay exceeds the threshold, else 0; also 0 for an unknown delay."""
    return F.coalesce(number(delay) > after, F.lit(False)).cast("int")


def flag(c: Column) -> Column:
    """0/1 flag read from any column; unreadable and missing values are 0."""
    return F.coalesce(number(c).try_cast("int"), F.lit(0))


def percent_deviation(value: Column, mean: Column) -> Column:
    """Deviation from the mean in percent, 2 decimals half-even; null for a zero mean."""
    return F.bround(100 * (value - mean) / F.nullif(mean, F.lit(0.0)), 2)


def over(percent: Column, threshold: float) -> Column:
    return F.coalesce(percent > threshold, F.lit(False)).cast("int")


def share(part: Column, whole: Column) -> Column:
    """Percentage, 0 when there is nothing to share."""
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)


def risk_band(minutes: Column) -> Column:
    return (
        F.when(minutes >= RISK_HIGH_FROM, "high")
        .when(minutes >= RISK_MEDIUM_FROM, "medium")
        .otherwise("low")
    )


def not_negative(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)


def min_max(c: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; a constant column becomes 0."""
    return F.when(high == low, 0.0).otherwise((c - low) / (high - low))


def weighted(first: Column, second: Column, first_weight: float = 0.7) -> Column:
    return first_weight * first + (1 - first_weight) * second
