"""Run-log views, alerts and table-health reports over ordinary tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar.functions.rates import percent, ratio, scaled
from clickstar.operators.quality import rows, status


def since(log: DataFrame, column: str, first: dt.date) -> DataFrame:
    return log.where(F.col(column) >= F.lit(first))


def on(log: DataFrame, column: str, day: dt.date) -> DataFrame:
    return log.where(F.col(column) == F.lit(day))


# --- run log -------------------------------------------------------------------------

def recent_runs(log: DataFrame, first: dt.date) -> DataFrame:
    """Runs of the look-back, newest first."""
    return since(log, "run_date", first).select(
        "run_id", "run_date", "dag_id", "task_id", "status", "rows_processed",
        scaled(F.col("bytes_processed"), V.GB).alias("bytes_processed_gb"), "duration_seconds",
        "error_message", "run_timestamp").orderBy(F.desc("run_timestamp"))


def latest_runs(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.desc("run_timestamp"), "run_id").limit(n)


def runs_by_day(log: DataFrame, first: dt.date) -> DataFrame:
    """Per day and job: runs, outcomes, rows, terabytes, mean duration."""
    return (since(log, "run_date", first).groupBy("run_date", "dag_id").agg(
        rows().alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.sum("rows_processed").alias("total_rows_processed"),
        scaled(F.sum("bytes_processed"), V.TB).alias("total_bytes_processed_tb"),
        F.round(F.avg("duration_seconds"), 4).alias("avg_duration_seconds"))
        .orderBy(F.desc("run_date")))


def runs_by_task(log: DataFrame, first: dt.date) -> DataFrame:
    return (since(log, "run_date", first).groupBy("dag_id", "task_id", "status").agg(
        rows().alias("execution_count"),
        F.round(F.avg("duration_seconds"), 4).alias("avg_duration_seconds"),
        F.sum("rows_processed").alias("total_rows"),
        scaled(F.sum("bytes_processed"), V.GB).alias("total_gb_processed"))
        .orderBy("dag_id", "task_id"))


def daily_summary(day: dt.date, flat: DataFrame, sessions: DataFrame, facts: DataFrame,
                  conversions: DataFrame) -> DataFrame:
    """Row counts of four tables for one day, as one row."""
    named = {"events_count": flat, "sessions_count": sessions, "fact_sessions_count": facts,
             "conversions_count": conversions}
    tagged = reduce(DataFrame.unionByName, [
        table.select(F.lit(name).alias("counted")) for name, table in named.items()])
    return tagged.agg(*[F.count_if(F.col("counted") == n).alias(n) for n in named]).select(
        F.lit(day).alias("report_date"), *named)


def pipeline_health(log: DataFrame, as_of: dt.date) -> DataFrame:
    """STALE, FAILED or HEALTHY per job, from its last run day.

    Failures are counted per job and day first, so the last day's flag needs no
    join back to the log.
    """
    days = log.groupBy("dag_id", "run_date").agg(
        F.max("run_timestamp").alias("last_run"),
        F.max(F.coalesce(F.col("status") == "failed", F.lit(False))).alias("any_failed"))
    latest = days.groupBy("dag_id").agg(
        F.max("last_run").alias("last_run"),
        F.max(F.struct("run_date", "any_failed")).alias("d"))
    stale = as_of - dt.timedelta(days=V.STALE_DAYS)
    return latest.select(
        "dag_id", "last_run", F.col("d.run_date").alias("last_run_date"),
        F.when(F.col("d.run_date") < F.lit(stale), "STALE")
        .when(F.col("d.any_failed"), "FAILED").otherwise("HEALTHY").alias("health_status"))


# --- alerts --------------------------------------------------------------------------

def missing_daily_data(flat: DataFrame, day: dt.date) -> DataFrame:
    counted = on(flat, "event_date_partition", day).agg(rows().alias("events_count"))
    return counted.select(F.lit("missing_daily_data").alias("alert_type"),
                          F.lit(day).alias("check_date"),
                          status(F.col("events_count") > 0).alias("status"), "events_count")


def daily_volumes(flat: DataFrame) -> DataFrame:
    return (flat.groupBy(F.col("event_date_partition").alias("date"))
            .agg(rows().alias("events_count")))


def volume_changes(flat: DataFrame) -> DataFrame:
    """Every day against the day before it; the join is over one row per day."""
    today = daily_volumes(flat)
    before = today.select(F.date_add("date", 1).alias("date"),
                          F.col("events_count").alias("previous_count"))
    both = today.join(before, "date", "left")
    gained = F.col("events_count") - F.col("previous_count")
    return both.withColumn("change", percent(gained, F.col("previous_count"))).select(
        F.lit("volume_drop").alias("alert_type"), F.col("date").alias("check_date"),
        F.when(F.col("change") < V.VOLUME_DROP * 100, "FAIL").otherwise("PASS").alias("status"),
        "events_count", "previous_count", F.round("change", 2).alias("pct_change"))


def volume_drop(flat: DataFrame, day: dt.date, first: dt.date) -> DataFrame:
    recent = flat.where(F.col("event_date_partition") >= F.lit(first))
    return volume_changes(recent).where(F.col("check_date") == F.lit(day))


def quality_failures(dq_log: DataFrame, day: dt.date) -> DataFrame:
    bad = F.count_if(F.col("status") == "FAIL")
    return (on(dq_log, "check_date", day).groupBy("check_date")
            .agg(bad.alias("failed_assertions"), rows().alias("total_assertions"))
            .select(F.lit("data_quality_failure").alias("alert_type"), "check_date",
                    "failed_assertions", "total_assertions",
                    status(F.col("failed_assertions") == 0).alias("status")))


def failure_messages(log: DataFrame, day: dt.date | None = None) -> DataFrame:
    """One row per day, job and message with its number of failed tasks."""
    failed = log.where(F.col("status") == "failed")
    if day is not None:
        failed = on(failed, "run_date", day)
    return failed.groupBy("run_date", "dag_id", "error_message").agg(rows().alias("n"))


def failed_jobs(log: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Failed tasks and their distinct messages per day and job, as one text.

    Tasks that failed alike are one row before the messages of a job meet; jobs whose messages
    carry ids or times have :func:`failure_messages`, one row per message.
    """
    per_message = failure_messages(log, day)
    return per_message.groupBy("run_date", "dag_id").agg(
        F.sum("n").alias("failed_tasks"),
        F.array_join(F.array_sort(F.collect_list("error_message")), "; ")
        .alias("error_messages")).select(
        F.lit("dag_failure").alias("alert_type"), "run_date", "dag_id", "failed_tasks",
        F.nullif("error_messages", F.lit("")).alias("error_messages"))


def high_query_cost(queries: DataFrame, first: dt.date) -> DataFrame:
    """Days on which queries above the size limit add up to more than the day limit."""
    large = queries.where((F.col("creation_time") >= F.lit(first))
                          & (F.col("total_bytes_billed") > V.HIGH_COST_QUERY_TB * V.TB))
    return (large.groupBy(F.to_date("creation_time").alias("query_date"))
            .agg(rows().alias("high_cost_queries"),
                 scaled(F.sum("total_bytes_billed"), V.TB).alias("total_tb_billed"))
            .where(F.col("total_tb_billed") > V.HIGH_COST_DAY_TB)
            .select(F.lit("high_query_cost").alias("alert_type"), "query_date",
                    "high_cost_queries", "total_tb_billed"))


def size_gb(column: str = "total_logical_bytes") -> Column:
    return F.col(column) / F.lit(V.GB)


def large_partitions(stats: DataFrame, day: dt.date | None = None,
                     limit_gb: float = V.LARGE_PARTITION_GB) -> DataFrame:
    """Partitions above the limit, of one day if given."""
    if day is not None:
        stats = stats.where(F.col("partition_id") == day.isoformat())
    return stats.where(size_gb() > limit_gb).select(
        F.lit("large_partition").alias("alert_type"), "table_name", "partition_id",
        F.round(size_gb(), 2).alias("size_gb"), "total_rows", F.lit("WARNING").alias("status"))


# --- trends --------------------------------------------------------------------------

def volume_trend(sessions: DataFrame, first: dt.date) -> DataFrame:
    """Events, distinct sessions and distinct users per day.

    From the session table, which holds every event's session, user and day in far fewer
    rows than there are events; only the look-back's partitions are read.
    """
    return (since(sessions, "session_date", first)
            .groupBy(F.col("session_date").alias("date"))
            .agg(F.sum("events_count").alias("events_count"),
                 F.count_distinct("session_id").alias("unique_sessions"),
                 F.count_distinct("user_pseudo_id").alias("unique_users"))
            .withColumn("avg_events_per_session",
                        F.round(ratio(F.col("events_count"), F.col("unique_sessions")), 2))
            .orderBy(F.desc("date")))


def query_performance(queries: DataFrame, first: dt.date) -> DataFrame:
    selects = queries.where((F.col("creation_time") >= F.lit(first))
                            & (F.col("statement_type") == "SELECT"))
    billed = F.col("total_bytes_billed")
    return (selects.groupBy(F.to_date("creation_time").alias("query_date"))
            .agg(rows().alias("total_queries"),
                 F.count_if(billed > V.LARGE_QUERY_GB * V.GB).alias("large_queries"),
                 scaled(F.avg(billed), V.GB).alias("avg_gb_billed"),
                 scaled(F.sum(billed), V.TB).alias("total_tb_billed"),
                 scaled(F.avg("total_slot_ms"), 1000.0).alias("avg_slot_seconds"))
            .orderBy(F.desc("query_date")))


def conversion_by_channel(facts: DataFrame, channels: DataFrame, first: dt.date) -> DataFrame:
    """Sessions, conversions, rate and value per channel."""
    n, conv = F.count_distinct("session_id"), F.count_if("has_conversion")
    return (since(facts, "session_date", first)
            .join(channels.select("channel_key", "channel_group", "channel_type"),
                  "channel_key", "left")
            .groupBy("channel_group", "channel_type")
            .agg(n.alias("sessions"), conv.alias("conversions"),
                 F.round(F.sum("total_conversion_value"), 4).alias("total_conversion_value"))
            .withColumn("conversion_rate", F.round(
                percent(F.col("conversions"), F.col("sessions")), 2))
            .orderBy(F.desc("sessions")))


# --- table health --------------------------------------------------------------------

def logical_bytes(table: DataFrame) -> Column:
    """Size of a row by its values: 8 bytes a number or time, 1 a flag, text plus 2."""
    sizes = []
    for field in table.schema.fields:
        kind = field.dataType.simpleString()
        if kind == "string":
            width = F.octet_length(field.name) + 2
        elif kind == "boolean":
            width = F.lit(1)
        else:
            width = F.lit(8)
        sizes.append(F.when(F.col(field.name).isNotNull(), width).otherwise(0).cast("bigint"))
    total = sizes[0]
    for size in sizes[1:]:
        total = total + size
    return total


def partition_stats(table: DataFrame, name: str, partition: str) -> DataFrame:
    """Rows and logical bytes of every day of a table."""
    sized = table.select(F.col(partition).alias("day"), logical_bytes(table).alias("bytes"))
    return (sized.groupBy("day").agg(rows().alias("total_rows"),
                                     F.sum("bytes").alias("total_logical_bytes"))
            .select(F.lit(name).alias("table_name"),
                    F.date_format("day", "yyyy-MM-dd").alias("partition_id"), "total_rows",
                    "total_logical_bytes"))


def file_stats(spark: SparkSession, path: str, name: str, partition: str) -> DataFrame:
    """Files and bytes on disk of every day, from the file listing: no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(
        path).select(F.col(partition).cast("date").alias("day"), F.col("length").alias("bytes"))
    return (files.groupBy("day").agg(rows().alias("files"), F.sum("bytes").alias("file_bytes"))
            .select(F.lit(name).alias("table_name"),
                    F.date_format("day", "yyyy-MM-dd").alias("partition_id"), "files",
                    "file_bytes"))


def newest_partitions(stats: DataFrame, n: int) -> DataFrame:
    return stats.orderBy(F.desc("partition_id")).limit(n)


def partition_report(stats: DataFrame, first: dt.date) -> DataFrame:
    """Sizes of the partitions of the look-back."""
    return stats.where(F.col("partition_id") >= first.isoformat()).select(
        "table_name", "partition_id", "total_rows", F.round(size_gb(), 2).alias("size_gb"),
        scaled(F.col("total_logical_bytes"), V.TB).alias("size_tb"))


def size_recommendation(stats: DataFrame, n: int = 20, small_gb: float = V.SMALL_PARTITION_GB,
                        large_gb: float = V.LARGE_PARTITION_GB) -> DataFrame:
    """Whether a partition is too small, too large or fine."""
    advice = (F.when(size_gb() < small_gb, V.PARTITION_TOO_SMALL)
              .when(size_gb() > large_gb, V.PARTITION_TOO_LARGE)
              .otherwise(V.PARTITION_OPTIMAL))
    return stats.select("table_name", "partition_id", F.round(size_gb(), 2).alias("size_gb"),
                        "total_rows", advice.alias("recommendation")).orderBy(
        "table_name", F.desc("partition_id")).limit(n)


def partition_usage(stats: DataFrame) -> DataFrame:
    return stats.groupBy("table_name").agg(
        F.count_distinct("partition_id").alias("num_partitions"),
        F.min("partition_id").alias("oldest_partition"),
        F.max("partition_id").alias("newest_partition"),
        F.sum("total_rows").alias("total_rows"),
        scaled(F.sum("total_logical_bytes"), V.TB).alias("total_size_tb"))


def _selects(queries: DataFrame, first: dt.date) -> DataFrame:
    return queries.where((F.col("creation_time") >= F.lit(first))
                         & (F.col("statement_type") == "SELECT"))


def expensive_queries(queries: DataFrame, first: dt.date, n: int = 10) -> DataFrame:
    """The largest reads of the look-back."""
    large = _selects(queries, first).where(
        F.col("total_bytes_processed") > V.LARGE_QUERY_GB * V.GB)
    return large.select("job_id", "creation_time", "total_bytes_processed",
                        "total_bytes_billed", "query").orderBy(
        F.desc("total_bytes_processed"), "job_id").limit(n)


def costliest_queries(queries: DataFrame, first: dt.date, n: int = 10) -> DataFrame:
    recent = queries.where(F.col("creation_time") >= F.lit(first))
    return recent.select("job_id", "creation_time", "total_bytes_processed",
                         "total_bytes_billed", "total_slot_ms").orderBy(
        F.desc("total_bytes_billed"), "job_id").limit(n)


def clustering_benefit(queries: DataFrame, first: dt.date, n: int = 10) -> DataFrame:
    """Queries that read less than half of what they were billed for."""
    processed, billed = F.col("total_bytes_processed"), F.col("total_bytes_billed")
    helped = _selects(queries, first).where(
        (processed > 0) & (processed < billed * V.CLUSTERING_BENEFIT))
    return helped.select("job_id", "creation_time", "total_bytes_processed",
                         "total_bytes_billed",
                         F.substring("query", 1, 100).alias("query_preview")).orderBy(
        F.desc("total_bytes_processed"), "job_id").limit(n)


def clustering_labels(queries: DataFrame, first: dt.date, n: int = 10) -> DataFrame:
    """The largest reads, labelled by whether clustering helped."""
    helped = F.col("total_bytes_processed") < F.col("total_bytes_billed") * V.CLUSTERING_BENEFIT
    label = F.when(helped, V.CLUSTERING_EFFECTIVE).otherwise(V.CLUSTERING_NOT_EFFECTIVE)
    return _selects(queries, first).select(
        "job_id", "total_bytes_processed", "total_bytes_billed",
        label.alias("clustering_effectiveness")).orderBy(
        F.desc("total_bytes_processed"), "job_id").limit(n)


def partitions_queried(queries: DataFrame, first: dt.date, table: str) -> DataFrame:
    """Per day: queries that name a table and the distinct days they ask for."""
    literal = F.nullif(F.regexp_extract("query", V.PARTITION_LITERAL_PATTERN, 1), F.lit(""))
    hits = queries.where((F.col("creation_time") >= F.lit(first))
                         & F.col("query").contains(table))
    return (hits.groupBy(F.to_date("creation_time").alias("query_date"))
            .agg(rows().alias("query_count"),
                 F.count_distinct(literal).alias("unique_partitions_queried"))
            .orderBy(F.desc("query_date")))
