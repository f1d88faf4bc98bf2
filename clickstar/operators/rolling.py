"""Users over a sliding window, from stored parts instead of the window's days.

A part holds one row per user for an aligned span of 1, 8 or 64 days. A daily load reads its own
day, writes that day's part and those of the spans it completes; a window of 90 days is then
at most 22 parts, each smaller than the sessions it stands for. Parts only merge (sums,
extremes, first sessions), nothing is ever subtracted from a total of doubles.

A session that runs on after midnight has a row on each of its days and counts once: a day's part
also counts the sessions that the day before has too, which are taken off unless the window starts
between the two days. So the days of one session must follow each other, as they do
when a session ends with inactivity.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar.operators import tables
from clickstar.operators.stage import USER_PICKS

SIZES = (1, 8, 64)
USER = ["user_pseudo_id", "user_id"]
DAY_SUMS = ["events", "pageviews", "conversions", "leads", "value", "revenue", "seconds", "timed",
            "engaged"]
SUMS = ["sessions", "carried", *DAY_SUMS]


def day_parts(sessions: DataFrame, before: DataFrame) -> DataFrame:
    """One row per day and user; ``before`` has the session ids of the days before these days.

    Sessions and the ids of the day before are stacked, so each is shuffled once: first by
    session, which counts every one once, then by user.
    """
    own = sessions.select(
        F.col("session_date").alias("from_day"), *USER, "session_id", F.lit(1).alias("_rows"),
        F.lit(0).alias("_before"), F.col("events_count").alias("events"), "pageviews",
        F.when(F.col("has_conversion"), 1).otherwise(0).alias("conversions"),
        F.when(F.col("has_lead"), 1).otherwise(0).alias("leads"),
        F.col("total_conversion_value").alias("value"),
        F.col("total_purchase_revenue").alias("revenue"),
        F.col("session_duration_seconds").alias("seconds"),
        F.col("session_duration_seconds").isNotNull().cast("int").alias("timed"),
        F.col("session_engaged").alias("engaged"),
        F.struct("session_date", "ga_session_id", "session_id", *USER_PICKS).alias("first"))
    ran_on = before.where("session_id IS NOT NULL").select(
        F.date_add("session_date", 1).alias("from_day"), *USER, "session_id",
        F.lit(0).alias("_rows"), F.lit(1).alias("_before"))
    once = own.unionByName(ran_on, allowMissingColumns=True).groupBy(
        "from_day", *USER, "session_id").agg(
        F.max("_rows").alias("_rows"), F.max("_before").alias("_before"),
        *[F.sum(c).alias(c) for c in DAY_SUMS], F.min("first").alias("first")).where("_rows = 1")
    return once.groupBy("from_day", *USER).agg(
        F.min("from_day").alias("first_day"), F.max("from_day").alias("last_day"),
        F.count("session_id").alias("sessions"), F.sum("_before").alias("carried"),
        *[F.sum(c).alias(c) for c in DAY_SUMS], F.min("first").alias("first")
    ).withColumn("carried_first", F.col("carried"))


def merged(parts: DataFrame, start: dt.date) -> DataFrame:
    """The parts of neighbouring spans as one that begins on ``start``."""
    begins = F.when(F.col("from_day") == F.lit(start), F.col("carried_first"))
    return parts.groupBy(*USER).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        *[F.sum(c).alias(c) for c in SUMS], F.min("first").alias("first"),
        F.coalesce(F.sum(begins), F.lit(0)).alias("carried_first")).select(
        F.lit(start).alias("from_day"), *USER, "first_day", "last_day", *SUMS, "first",
        "carried_first")


def as_users(state: DataFrame) -> DataFrame:
    """The columns of the user table."""
    return state.select(
        *USER, F.col("first_day").alias("user_first_seen_date"),
        F.col("last_day").alias("user_last_seen_date"),
        F.datediff("last_day", "first_day").cast("bigint").alias("user_lifetime_days"),
        (F.col("sessions") - F.col("carried") + F.col("carried_first")).alias("total_sessions"),
        F.col("events").alias("total_events"), F.col("pageviews").alias("total_pageviews"),
        F.col("conversions").alias("total_conversions"), F.col("leads").alias("total_leads"),
        F.col("value").alias("total_user_conversion_value"),
        F.col("revenue").alias("total_user_purchase_revenue"),
        F.try_divide(F.col("seconds"), F.col("timed")).alias("avg_session_duration_seconds"),
        F.col("engaged").alias("total_engaged_sessions"),
        *[F.col(f"first.{c}").alias(name) for c, name in USER_PICKS.items()])


# --- stored parts ------------------------------------------------------------------------


def folder(path: str, size: int, start: dt.date) -> str:
    return f"{path}/days={size}/start={start:%Y%m%d}"


def stored(spark: SparkSession, path: str, size: int) -> set[dt.date]:
    """Starts of the finished parts of one size."""
    found = tables.numbered_folders(spark, f"{path}/days={size}", "start")
    return {dt.datetime.strptime(str(n), "%Y%m%d").date() for n in found}


def aligned(day: dt.date, size: int) -> dt.date:
    """Start of the span of ``size`` days that a day lies in."""
    return day - dt.timedelta(days=day.toordinal() % size)


def cover(spark: SparkSession, path: str, first: dt.date, last: dt.date,
          sizes: tuple[int, ...] = SIZES) -> list[str]:
    """Folders of the fewest parts that make up the days from first to last."""
    starts = {size: stored(spark, path, size) for size in sizes}
    out, day = [], first
    while day <= last:
        fits = [s for s in sizes if day in starts[s] and day + dt.timedelta(days=s - 1) <= last]
        if fits:
            out.append(folder(path, max(fits), day))
        day += dt.timedelta(days=max(fits, default=1))
    return out


def build(spark: SparkSession, path: str, sessions: DataFrame, days: list[dt.date]) -> None:
    """Writes the parts of ``days`` again, and of the longer spans they touch or complete.

    Longer spans go before their days change and come back last, so a run that stops half-way
    leaves windows that are put together from days.
    """
    before = stored(spark, path, 1)
    days = sorted(days)
    for size in SIZES[1:]:
        for start in {aligned(d, size) for d in days} & stored(spark, path, size):
            tables.drop(spark, folder(path, size, start))
    day = F.col("session_date")
    names = ["session_date", "session_id", *USER]
    for chunk in [days] if not before else [[d] for d in days]:
        past = sessions.where(day.isin([d - dt.timedelta(days=1) for d in chunk])).select(*names)
        parts = day_parts(sessions.where(day.isin(chunk)), past)
        if len(chunk) == 1:
            parts.write.mode("overwrite").parquet(folder(path, 1, chunk[0]))
        else:
            (parts.withColumn("start", F.date_format("from_day", "yyyyMMdd"))
             .hint("rebalance", F.col("start")).write.mode("overwrite").partitionBy("start")
             .parquet(f"{path}/days=1"))
    newest = max(stored(spark, path, 1) | set(days))
    old = max(before, default=dt.date.min)
    for i, size in enumerate(SIZES[1:], 1):
        length = dt.timedelta(days=size)
        starts, at = {aligned(d, size) for d in days}, aligned(max(old, days[0]), size)
        while at <= newest:
            starts.add(at)
            at += length
        for start in sorted(s for s in starts if s + length - dt.timedelta(days=1) <= newest):
            folders = cover(spark, path, start, start + length - dt.timedelta(days=1), SIZES[:i])
            if folders:
                merged(spark.read.parquet(*folders), start).write.mode("overwrite").parquet(
                    folder(path, size, start))


def users_rolled(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame | None:
    """The users of the window, or None where no part lies in it."""
    folders = cover(spark, path, first, last)
    return as_users(merged(spark.read.parquet(*folders), first)) if folders else None


def forget(spark: SparkSession, path: str, cutoff: dt.date) -> int:
    """Drops parts that end before ``cutoff``; returns how many."""
    old = [(size, s) for size in SIZES for s in stored(spark, path, size)
           if s + dt.timedelta(days=size) <= cutoff]
    for size, start in old:
        tables.drop(spark, folder(path, size, start))
    return len(old)
