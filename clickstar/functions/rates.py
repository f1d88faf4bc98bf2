"""Dashboard ratios; a zero denominator gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column) -> Column:
    """One division, so that an exact half is still one when it is rounded."""
    return ratio(top * F.lit(100), bottom)


def rounded_sum(value: Column, digits: int = 4) -> Column:
    """Sum of doubles, rounded so that the order of addition cannot show."""
    return F.round(F.sum(value), digits)


def scaled(value: Column, unit: float, digits: int = 2) -> Column:
    return F.round(value / F.lit(unit), digits)
