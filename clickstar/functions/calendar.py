"""Calendar fields that Spark's week functions do not give directly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(day: Column) -> Column:
    """Week of year 0-53, weeks starting on Sunday."""
    return F.floor((F.dayofyear(day) + F.lit(7) - F.dayofweek(day)) / F.lit(7)).cast("bigint")


def sunday_week_start(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - F.lit(1))


def monday_week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)
