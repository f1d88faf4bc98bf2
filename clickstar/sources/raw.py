"""Scans. Every date filter is on the bare partition column, so it prunes files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar.schemas import RAW_EVENTS


def open_export(spark: SparkSession, root: str) -> DataFrame:
    """The daily export: one ``event_date=yyyyMMdd`` folder per day.

    Part-day exports live under another root and are never read here.
    """
    return with_suffix(spark.read.schema(RAW_EVENTS).parquet(root))


def with_suffix(raw: DataFrame) -> DataFrame:
    return raw.withColumn("table_suffix", F.col("event_date"))


def scan_raw(raw: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """All shards from ``first`` to ``last``, both included."""
    return raw.where(F.col("event_date").between(first.strftime("%Y%m%d"),
                                                 last.strftime("%Y%m%d")))


def scan_raw_day(raw: DataFrame, day: dt.date) -> DataFrame:
    return raw.where(F.col("event_date") == day.strftime("%Y%m%d"))


def scan_partition(table: DataFrame, column: str, day: dt.date) -> DataFrame:
    return table.where(F.col(column) == F.lit(day))


def scan_lookback(table: DataFrame, column: str, first: dt.date) -> DataFrame:
    """Open range from ``first`` on."""
    return table.where(F.col(column) >= F.lit(first))


def raw_arrived(raw: DataFrame, day: dt.date) -> DataFrame:
    """One row: has the day's shard arrived, and with how many rows."""
    return scan_raw_day(raw, day).agg(
        F.lit(day).alias("run_date"), F.count(F.lit(1)).alias("raw_rows"),
        (F.count(F.lit(1)) > 0).alias("arrived"))


def has_rows(raw: DataFrame, day: dt.date) -> bool:
    """Job precondition; stops at the first row found."""
    return not scan_raw_day(raw, day).isEmpty()


def list_shards(raw: DataFrame, newest: int = 10) -> DataFrame:
    """The newest shards with their row counts."""
    return (raw.groupBy("table_suffix").agg(F.count(F.lit(1)).alias("raw_rows"))
            .orderBy(F.desc("table_suffix")).limit(newest))


def sample_shard(raw: DataFrame, day: dt.date, rows: int = 10) -> DataFrame:
    """The first rows of a shard by time, to look at."""
    return (scan_raw_day(raw, day).orderBy("event_timestamp", "src_event_id").limit(rows))


def shard_fingerprints(raw: DataFrame) -> DataFrame:
    """One row per shard that tells its content: it does not depend on files or the order of rows.

    The exclusive or of row hashes alone would miss rows that come twice, their sum alone a few swaps.
    """
    row = F.xxhash64(F.struct(*[c for c in RAW_EVENTS.names if c != "event_date"]))
    return raw.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.bit_xor(row).alias("hash_xor"),
        F.sum(F.pmod(row, F.lit(1 << 31))).alias("hash_sum"))


FINGERPRINT = "event_date string, raw_rows bigint, hash_xor bigint, hash_sum bigint"


def changed_shards(now: DataFrame, known: DataFrame) -> DataFrame:
    """(event_date, is_new) of the shards whose fingerprint is not the known one."""
    before = known.select(F.col("event_date").alias("_day"), *[
        F.col(c).alias(f"_{c}") for c in ("raw_rows", "hash_xor", "hash_sum")])
    same = ((F.col("raw_rows") == F.col("_raw_rows")) & (F.col("hash_xor") == F.col("_hash_xor"))
            & (F.col("hash_sum") == F.col("_hash_sum")))
    return now.join(before, F.col("event_date") == F.col("_day"), "left").where(
        F.col("_day").isNull() | ~same).select("event_date", F.col("_day").isNull().alias("is_new"))
