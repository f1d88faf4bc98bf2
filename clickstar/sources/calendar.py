"""Generated row sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar import fixed_values as V


def generate_dates(spark: SparkSession, first: str = V.CALENDAR_START,
                   last: str = V.CALENDAR_END) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
        .alias("date_value"))


def holidays(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(d).cast("date") for d in V.HOLIDAYS])).alias("holiday_date"))
