"""Lifetime conversion numbers from counters that are carried from day to day.

``through=YYYYMMDD`` holds each user's conversions up to that day. A day's numbers continue from the
newest counters before it, so history is not numbered again; a day that runs again starts from
the counters of the day before and replaces its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar.operators import facts, tables
from clickstar.operators.numbering import number_rows

COUNTERS = "user_pseudo_id string, conversions bigint"


def through(spark: SparkSession, path: str) -> list[dt.date]:
    """Days with finished counters."""
    found = tables.numbered_folders(spark, path, "through")
    return [dt.datetime.strptime(str(n), "%Y%m%d").date() for n in found
            if tables.exists(spark, f"{path}/through={n}/_SUCCESS")]


def counters_before(spark: SparkSession, path: str, flat: DataFrame, day: dt.date) -> DataFrame:
    """Each user's conversions on all days before ``day``.

    Days between the newest counters and ``day`` are counted from the flat events: none in a
    load that runs every day, all of them before the first counters.
    """
    known = [d for d in through(spark, path) if d < day]
    at = F.col("event_date_partition")
    since = flat.where(at < F.lit(day))
    parts = spark.createDataFrame([], COUNTERS)
    if known:
        parts = spark.read.schema(COUNTERS).parquet(f"{path}/through={known[-1]:%Y%m%d}")
        since = since.where(at > F.lit(known[-1]))
    return summed(parts.unionByName(counted(since)))


def counted(flat: DataFrame) -> DataFrame:
    return facts.conversions(flat).groupBy("user_pseudo_id").agg(
        F.count(F.lit(1)).alias("conversions"))


def summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user_pseudo_id").agg(F.sum("conversions").alias("conversions"))


def numbered_day(flat_day: DataFrame, before: DataFrame) -> DataFrame:
    """The day's conversions, numbered on from the counters."""
    return number_rows(facts.conversions(flat_day), ["user_pseudo_id"], "conversion_number",
                       before=before.withColumnRenamed("conversions", "rows")).withColumn(
        "is_first_conversion", F.col("conversion_number") == 1)


NUMBERS = ["src_event_id", "user_pseudo_id", "event_name", "conversion_number",
           "is_first_conversion"]


def backfill(spark: SparkSession, counters: str, numbers: str, flat: DataFrame, last: dt.date) -> None:
    """Numbers of all days up to ``last`` at once, and the counters to go on from."""
    past = flat.where(F.col("event_date_partition") <= F.lit(last))
    rows = facts.numbered_conversions(past, lifetime=True).select(
        *NUMBERS, F.col("event_date_partition").alias("conversion_date"))
    tables.write_partitioned(rows, numbers, "conversion_date", ("user_pseudo_id",))
    counted(past).write.mode("overwrite").parquet(f"{counters}/through={last:%Y%m%d}")


def load_day(spark: SparkSession, counters: str, numbers: str, flat: DataFrame, day: dt.date,
             keep: int = 40) -> None:
    """Writes the day's numbers, then its counters; later counters are out of date and go.

    The newest ``keep`` counters stay for days that are loaded again; older ones only cost a count of
    the days since, if they are ever needed.
    """
    before = counters_before(spark, counters, flat, day)
    of_day = flat.where(F.col("event_date_partition") == F.lit(day))
    rows = numbered_day(of_day, before).select(*NUMBERS)
    for later in [d for d in through(spark, counters) if d > day]:
        tables.drop(spark, f"{counters}/through={later:%Y%m%d}")
    rows.sortWithinPartitions("user_pseudo_id").write.mode("overwrite").parquet(
        f"{numbers}/conversion_date={day}")
    summed(before.unionByName(counted(of_day))).write.mode("overwrite").parquet(
        f"{counters}/through={day:%Y%m%d}")
    for old in through(spark, counters)[:-keep]:
        tables.drop(spark, f"{counters}/through={old:%Y%m%d}")
