"""Streaming jobs. Each takes a streaming DataFrame and returns a started query.

The batch functions are reused unchanged. A job keeps no state and no watermark: every
micro-batch is aggregated by itself and written under its number as parts that can be
combined, and a reader combines the parts of all batches. So the result depends neither
on the size of a batch nor on the order in which files arrive, and no row is ever too
late. A batch that runs again after a failure overwrites its own folder. From time to
time finished parts are combined into one table, which bounds what readers read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from clickstar import fixed_values as V
from clickstar.functions.rates import percent
from clickstar.operators import facts, merge, stage, tables
from clickstar.schemas import RAW_EVENTS, Table
from clickstar.sources.raw import with_suffix

# Parts of a tier that make one of the next.
COMPACT_EVERY = 16
SESSION_DAY = list(stage.SESSION_GRAIN)


def open_stream(spark: SparkSession, root: str, schema: StructType = RAW_EVENTS,
                files_per_batch: int = 1000) -> DataFrame:
    """New files under a partitioned export as a stream; results do not depend on the limit."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(root))


def flat_stream(raw: DataFrame) -> DataFrame:
    """Flat events with their real time as ``event_at``."""
    flat = stage.flatten(with_suffix(raw))
    return flat.withColumn("event_at", F.timestamp_micros("event_timestamp"))


def _each_batch(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None],
                continuous: str | None) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = (writer.trigger(processingTime=continuous) if continuous
              else writer.trigger(availableNow=True))
    return writer.foreachBatch(write).start()


# --- parts -------------------------------------------------------------------------------


def _starts(spark: SparkSession, path: str, tier: int) -> list[int]:
    """First batches of the finished folders of a tier."""
    head = f"{path}/tier={tier}"
    return [n for n in tables.numbered_folders(spark, head, "start")
            if tables.exists(spark, f"{head}/start={n}/_SUCCESS")]


def _tiers(spark: SparkSession, path: str) -> list[int]:
    return tables.numbered_folders(spark, path, "tier")


def part_folders(spark: SparkSession, path: str, fan: int) -> list[str]:
    """The folders that count: of those that cover a batch, the one of the highest tier."""
    out, taken = [], []
    for tier in reversed(_tiers(spark, path)):
        for start in _starts(spark, path, tier):
            if not any(a <= start < b for a, b in taken):
                taken.append((start, start + fan ** tier))
                out.append(f"{path}/tier={tier}/start={start}")
    return out


def open_parts(spark: SparkSession, path: str) -> DataFrame:
    """All parts of a stream, each batch once."""
    return spark.read.parquet(*part_folders(spark, path, _fan(spark, path)))


def _fan(spark: SparkSession, path: str) -> int:
    """How many parts make one of the next tier; the folder keeps what its stream began with."""
    return tables.numbered_folders(spark, path, "fan")[0]


def compact(spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame], fan: int,
            upto: int) -> None:
    """Combines every full run of ``fan`` parts of a tier, before batch ``upto``, into one of the next.

    A row is written once per tier, so the work grows with the logarithm of the number of batches,
    and readers find fewer than ``fan`` folders a tier. A crash in between leaves parts that a
    finished folder already covers: readers skip them and the next compaction drops them.
    """
    tier, width = 0, 1
    while width * fan <= upto:
        start = upto - upto % (width * fan) - width * fan
        of_next = f"{path}/tier={tier + 1}/start={start}"
        if not tables.exists(spark, f"{of_next}/_SUCCESS"):
            inside = [n for n in _starts(spark, path, tier) if start <= n < start + width * fan]
            if inside:
                folders = [f"{path}/tier={tier}/start={n}" for n in inside]
                tables.write_replace(combine(spark.read.parquet(*folders)), of_next)
        for n in tables.numbered_folders(spark, f"{path}/tier={tier}", "start"):
            if start <= n < start + width * fan:
                tables.drop(spark, f"{path}/tier={tier}/start={n}")
        tier, width = tier + 1, width * fan


def _parts(path: str, aggregate: Callable[[DataFrame], DataFrame],
           combine: Callable[[DataFrame], DataFrame], every: int
           ) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        """The batch at hand may run again, so only those before it are combined."""
        spark = batch.sparkSession
        if number == 0:
            tables.mark(spark, f"{path}/fan={every}")
        aggregate(batch).write.mode("overwrite").parquet(f"{path}/tier=0/start={number}")
        if number and number % every == 0:
            compact(spark, path, combine, every, number)

    return write


# --- jobs --------------------------------------------------------------------------------


def stream_flatten(raw: DataFrame, path: str, checkpoint: str,
                   continuous: str | None = None) -> StreamingQuery:
    """Appends flat events as files arrive; no state."""
    flat = stage.flatten(with_suffix(raw))
    writer = (flat.writeStream.format("parquet").outputMode("append")
              .partitionBy("event_date_partition").option("path", path)
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(processingTime=continuous) if continuous
              else writer.trigger(availableNow=True))
    return writer.start()


def volume_parts(flat: DataFrame) -> DataFrame:
    """Events per day and a sketch of their distinct sessions."""
    return flat.groupBy(F.to_date("event_at").alias("date")).agg(
        F.count(F.lit(1)).alias("events_count"),
        F.count("session_id").alias("events_with_session"),
        F.hll_sketch_agg("session_id").alias("sessions"))


def combined_volume(parts: DataFrame) -> DataFrame:
    return parts.groupBy("date").agg(
        F.sum("events_count").alias("events_count"),
        F.sum("events_with_session").alias("events_with_session"),
        F.hll_union_agg("sessions").alias("sessions"))


def stream_volume(raw: DataFrame, path: str, checkpoint: str, continuous: str | None = None,
                  every: int = COMPACT_EVERY) -> StreamingQuery:
    return _each_batch(flat_stream(raw), checkpoint,
                       _parts(path, volume_parts, combined_volume, every), continuous)


def daily_volume(spark: SparkSession, path: str) -> DataFrame:
    """Events, events with a session and about how many sessions per day, so far."""
    return combined_volume(open_parts(spark, path)).select(
        "date", "events_count", "events_with_session",
        F.hll_sketch_estimate("sessions").alias("approx_sessions"))


def open_heartbeat(spark: SparkSession) -> DataFrame:
    """One row a second with the time, for :func:`stream_alerts`: it comes without any data."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


def day_alerts(volumes: DataFrame, as_of: dt.date, lookback: int = 7) -> DataFrame:
    """Missing data and volume drop of every finished day of the look-back, silent days included.

    Days before the first event do not count. A silent day is missing and, unless the day before
    was silent too, also a drop.
    """
    last = F.lit(as_of - dt.timedelta(days=1))
    days = volumes.agg(F.greatest(F.min("date"), F.date_sub(last, lookback)).alias("first")).select(
        F.explode(F.sequence("first", last)).alias("date"))
    known = days.join(volumes.select("date", "events_count"), "date", "left").select(
        "date", F.coalesce("events_count", F.lit(0)).alias("events_count"))
    before = known.select(F.date_add("date", 1).alias("date"),
                          F.col("events_count").alias("previous_count"))
    both = known.join(before, "date", "left").withColumn("change", percent(
        F.col("events_count") - F.col("previous_count"), F.col("previous_count")))
    missing = both.select(
        F.lit("missing_daily_data").alias("alert_type"), F.col("date").alias("check_date"),
        F.when(F.col("events_count") > 0, "PASS").otherwise("FAIL").alias("status"), "events_count",
        F.lit(None).cast("bigint").alias("previous_count"), F.lit(None).cast("double").alias("pct_change"))
    return missing.unionByName(both.select(
        F.lit("volume_drop").alias("alert_type"), F.col("date").alias("check_date"),
        F.when(F.col("change") < V.VOLUME_DROP * 100, "FAIL").otherwise("PASS").alias("status"),
        "events_count", "previous_count", F.round("change", 2).alias("pct_change")))


def stream_alerts(heartbeat: DataFrame, volumes: str, path: str, checkpoint: str, lookback: int = 7,
                  continuous: str | None = None) -> StreamingQuery:
    """Checks the volumes of a running :func:`stream_volume` whenever the heartbeat brings a new day.

    The beat, not the data, drives it, so a day without a single event raises its alert. The alerts of
    one day are one folder, written again if a batch runs again.
    """
    def check(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.max(F.to_date("timestamp"))).first()[0]
        if newest is None or tables.exists(spark, f"{path}/as_of={newest}/_SUCCESS"):
            return
        alerts = day_alerts(daily_volume(spark, volumes), newest, lookback)
        alerts.coalesce(1).write.mode("overwrite").parquet(f"{path}/as_of={newest}")

    return _each_batch(heartbeat.select("timestamp"), checkpoint, check, continuous)


def open_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts so far, with the day they were made on as ``as_of``."""
    return spark.read.parquet(path)


def session_parts(flat: DataFrame) -> DataFrame:
    dated = flat.withColumn("session_date", F.to_date("event_at"))
    return dated.groupBy(*SESSION_DAY).agg(
        *[c.alias(n) for n, c in stage.session_parts("event").items()])


def combined_sessions(parts: DataFrame) -> DataFrame:
    return stage.combined_parts(parts, SESSION_DAY)


def stream_sessions(raw: DataFrame, path: str, checkpoint: str, continuous: str | None = None,
                    every: int = COMPACT_EVERY) -> StreamingQuery:
    """Sessions built up batch by batch, one row per session, user and day in each."""
    return _each_batch(flat_stream(raw), checkpoint,
                       _parts(path, session_parts, combined_sessions, every), continuous)


def sessions_so_far(spark: SparkSession, path: str) -> DataFrame:
    return combined_sessions(open_parts(spark, path)).select(
        *stage.session_columns(SESSION_DAY))


def stream_gap_sessions(raw: DataFrame, path: str, checkpoint: str, gap_minutes: int = 30,
                        continuous: str | None = None, every: int = COMPACT_EVERY,
                        slot_minutes: int = 60) -> StreamingQuery:
    """Gap sessions as spans of each batch, chained again whenever parts are combined."""
    return _each_batch(flat_stream(raw), checkpoint, _parts(
        path, lambda flat: stage.gap_pieces(flat, gap_minutes, slot_minutes),
        lambda parts: stage.combined_spans(parts, gap_minutes, slot_minutes), every), continuous)


def gap_sessions_so_far(spark: SparkSession, path: str, gap_minutes: int = 30,
                        slot_minutes: int = 60) -> DataFrame:
    """Sessions so far; gap and slot are those the stream was started with."""
    return stage.chained(open_parts(spark, path), gap_minutes, slot_minutes)


def stream_upsert_events(raw: DataFrame, dims: dict[str, DataFrame], table: Table, path: str,
                         staging: str, checkpoint: str, continuous: str | None = None
                         ) -> StreamingQuery:
    """Upserts events into the event fact; an event that comes again changes nothing."""
    def upsert(batch: DataFrame, number: int) -> None:
        """Stages the batch once, as the merge reads its source several times and drops repeats."""
        folder = f"{staging}/batch={number}"
        rows = facts.fact_events(batch, dims, conformed=True)
        rows = rows.withColumn("_etl_timestamp", F.lit(None).cast("timestamp"))
        rows.write.mode("overwrite").parquet(folder)
        merge.merge_table(batch.sparkSession, path, batch.sparkSession.read.parquet(folder),
                          table, repeats=True)
        tables.drop(batch.sparkSession, folder)

    return _each_batch(flat_stream(raw), checkpoint, upsert, continuous)
