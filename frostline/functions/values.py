"""Scalar rules for measured values. Missing is NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: offset between the Kelvin and Celsius scales.
KELVIN_OFFSET = 273.15


def not_nan(value: Column) -> Column:
    """NaN becomes NULL, so aggregates skip it and comparisons never see it as large."""
    return F.when(~F.isnan(value), value)


def parse_value(raw: Column, bad: str = "Bad") -> Column:
    """Logger token to DOUBLE; the bad marker and anything unreadable become NULL."""
    return not_nan(F.nullif(F.trim(raw), F.lit(bad)).try_cast("double"))


def to_celsius(value: Column, variable: Column, units: Column, temperature: str = "t2m") -> Column:
    """Kelvin temperatures to Celsius; every other variable is left alone."""
    is_kelvin = F.coalesce((variable == temperature) & (units == "K"), F.lit(False))
    return F.when(is_kelvin, value - F.lit(KELVIN_OFFSET)).otherwise(value)


def clamp_min0(value: Column) -> Column:
    """Negative values to 0; a missing value stays missing."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def keep_where(value: Column, condition: Column) -> Column:
    """Keep the value where the condition is true; an undecided condition loses it."""
    return F.when(F.coalesce(condition, F.lit(False)), value)


def drop_where(value: Column, condition: Column) -> Column:
    """Lose the value where the condition is true; an undecided condition keeps it."""
    return F.when(~F.coalesce(condition, F.lit(False)), value)


def within_upper(value: Column, upper: float, inclusive: bool = True) -> Column:
    return value <= upper if inclusive else value < upper


def threshold_flag(value: Column, threshold: float, include_zero: bool = False) -> Column:
    """1 where ``0 < value <= threshold`` (or ``0 <=`` with ``include_zero``), else 0."""
    above = value >= 0 if include_zero else value > 0
    return F.when(above & (value <= threshold), F.lit(1)).otherwise(F.lit(0))


def round_half_even(value: Column) -> Column:
    """Nearest integer, halves to the even neighbour."""
    return F.bround(value, 0).cast("int")
