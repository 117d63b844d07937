"""Numeric column helpers: clamps, guarded division, rounding conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, lo: float, hi: float) -> Column:
    """CASE x < lo THEN lo WHEN x > hi THEN hi ELSE x (nulls stay null)."""
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def guarded_divide(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den when den > 0, else ``default`` (ANSI-safe: never divides by 0)."""
    out = F.when(den > 0, num / den)
    return out if default is None else out.otherwise(F.lit(default))


def half_up_integer(x: Column) -> Column:
    """Round half towards +infinity to an integer (the browser's Math.round)."""
    return F.floor(x + F.lit(0.5))


def half_even(x: Column, digits: int) -> Column:
    """Round half to even at ``digits`` decimals (Python's round on display values)."""
    return F.bround(x, digits)
