"""Rates rounded half-up from whole numbers, so every engine gives the same digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(part: Column, whole: Column, scale: int, digits: int) -> Column:
    """``round(scale * part / whole, digits)`` without binary rounding; null when ``whole`` is 0."""
    shift = 10 ** digits
    units = F.call_function("div", part * F.lit(2 * scale * shift) + whole, F.nullif(whole * 2, F.lit(0)))
    return units.cast("double") / F.lit(float(shift))


def percent(part: Column, whole: Column) -> Column:
    return half_up(part, whole, 100, 1)


def multiple(part: Column, whole: Column) -> Column:
    return half_up(part, whole, 1, 2)
