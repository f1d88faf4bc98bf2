"""The daily load: one run date from the export to facts, summary and checks.

Every step replaces or merges exactly the days it covers, so a run can be repeated.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar import schemas
from clickstar.operators import dims as D
from clickstar.operators import (facts, lifetime, marts, merge, monitor, quality, rolling, rollup,
                                 stage, tables)
from clickstar.params import RunParams
from clickstar.session import side_by_side
from clickstar.sources import raw

JOB = "daily_load"


class RawDataMissing(RuntimeError):
    """The day's export has not arrived."""


@dataclass
class DailyLoad:
    spark: SparkSession
    export: str
    root: str
    params: RunParams
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def path(self, name: str) -> str:
        return f"{self.root}/{schemas.TABLES[name].layer}/{name}"

    def read(self, name: str) -> DataFrame:
        table = schemas.TABLES[name]
        if table.schema is not None:
            return tables.read_table(self.spark, self.path(name), table.schema)
        return self.spark.read.parquet(self.path(name))

    def read_day(self, name: str) -> DataFrame:
        return raw.scan_partition(self.read(name), schemas.TABLES[name].partition,
                                  self.params.run_date)

    def stamp(self, df: DataFrame) -> DataFrame:
        run_ts = self.params.run_ts or dt.datetime.combine(self.params.as_of, dt.time(2))
        return df.withColumn("_etl_timestamp", F.lit(run_ts.isoformat()).cast("timestamp"))

    # --- steps -----------------------------------------------------------------------

    def check_raw(self, days: int = 1) -> None:
        export = raw.open_export(self.spark, self.export)
        if not raw.has_rows(export, self.params.run_date):
            raise RawDataMissing(self.params.run_date.isoformat())

    # --- arrival ---

    def fingerprints(self, lookback: int) -> DataFrame:
        """Of the shards of the look-back, written so that they are those of one moment."""
        last = self.params.run_date
        shards = raw.scan_raw(raw.open_export(self.spark, self.export),
                              last - dt.timedelta(days=lookback - 1), last)
        staged = f"{self.ledger}.{self.run_id}"
        tables.write_replace(raw.shard_fingerprints(shards), staged)
        return self.spark.read.schema(raw.FINGERPRINT).parquet(staged)

    @property
    def ledger(self) -> str:
        return f"{self.root}/stage/raw_fingerprints"

    def changed_days(self, now: DataFrame) -> list[dt.date]:
        """Days whose shards are new or not what was loaded; a handful of names."""
        known = self.spark.createDataFrame([], raw.FINGERPRINT)
        if tables.exists(self.spark, self.ledger):
            known = self.spark.read.schema(raw.FINGERPRINT).parquet(self.ledger)
        return sorted(dt.datetime.strptime(r["event_date"], "%Y%m%d").date()
                      for r in raw.changed_shards(now, known).collect())

    def remember(self, now: DataFrame) -> None:
        """Notes what was loaded, from before the load: a later change is seen by the next run."""
        tables.write_partitioned(now, self.ledger, "event_date", rebalance=False)
        tables.drop(self.spark, f"{self.ledger}.{self.run_id}")

    def stg_events_flat(self, days: int = 1) -> None:
        """Input files hold one day each, so the rows are written without a shuffle."""
        last = self.params.run_date
        shards = raw.scan_raw(raw.open_export(self.spark, self.export),
                              last - dt.timedelta(days=days - 1), last)
        table = schemas.TABLES["stg_events_flat"]
        tables.write_partitioned(self.stamp(stage.flatten(shards)), self.path(table.name),
                                 table.partition, table.cluster, rebalance=False,
                                 lookups=table.lookups)

    def stg_sessions(self, days: int = 1) -> None:
        first = self.params.run_date - dt.timedelta(days=days - 1)
        flat = self.read("stg_events_flat").where(
            F.col("event_date_partition").between(F.lit(first), F.lit(self.params.run_date)))
        table = schemas.TABLES["stg_sessions"]
        rows = stage.sessions(flat, "event", self.params.lenient)
        tables.write_partitioned(self.stamp(rows), self.path(table.name), table.partition,
                                 table.cluster, lookups=table.lookups)

    def stg_users(self, lookback: int = 90, days: int = 1) -> None:
        """Put together from stored parts: only the days loaded are read from the sessions.

        The first run makes the parts of the whole look-back.
        """
        last, first = self.params.run_date, self.params.days_back(lookback)
        parts, table = f"{self.path('stg_users')}_parts", schemas.TABLES["stg_users"]
        new = [last - dt.timedelta(days=back) for back in range(days)]
        held = tables.partition_days(self.spark, self.path("stg_sessions"), "session_date")
        if not rolling.stored(self.spark, parts, 1):
            new = sorted({*new, *(d for d in held if d >= first)})
        rolling.build(self.spark, parts, self.read("stg_sessions"), new)
        rolling.forget(self.spark, parts, first)
        rolled = rolling.users_rolled(self.spark, parts, first, max([*held, last]))
        rows = tables.laid_out(self.stamp(rolled), "user_first_seen_date", table.cluster)
        tables.replace_safely(rows, self.path("stg_users"), "user_first_seen_date")

    def dimension(self, name: str) -> None:
        """Extends a dimension by the day's new members; reads one day only.

        The new version is written beside the table and swapped in, as a plan cannot
        overwrite the folder it reads.
        """
        dim, path = D.DIMENSIONS[name], self.path(name)
        tables.recover(self.spark, path)
        day = self.read_day("stg_sessions" if dim is D.CHANNEL else "stg_events_flat")
        if tables.exists(self.spark, path):
            rows = D.extend(self.read(name), day, dim)
        else:
            rows = D.conformed(day, dim)
        staged = f"{path}.{self.run_id}"
        tables.write_replace(self.stamp(rows), staged)
        tables.swap_in(self.spark, staged, path)

    def dim_date(self) -> None:
        tables.replace_safely(self.stamp(D.dim_date(self.spark)), self.path("dim_date"))

    def dims(self, events: bool = False) -> dict[str, DataFrame]:
        names = [n for n in D.DIMENSIONS if events or n != "dim_event_type"]
        return {n: self.read(n) for n in names}

    def fact(self, name: str) -> None:
        """Builds the day's rows once, then merges them."""
        if name == "fact_sessions":
            rows = facts.fact_sessions(self.read_day("stg_sessions"), self.dims(), True)
        else:
            build = facts.fact_events if name == "fact_events" else facts.fact_conversions
            rows = build(self.read_day("stg_events_flat"), self.dims(True), conformed=True,
                         lenient=self.params.lenient)
        staged = f"{self.path(name)}.{self.run_id}"
        tables.write_replace(self.stamp(rows), staged)
        merge.merge_table(self.spark, self.path(name), self.spark.read.parquet(staged),
                          schemas.TABLES[name])
        tables.drop(self.spark, staged)
        if name == "fact_conversions":
            self.lifetime_numbers()
        if name == "fact_sessions":
            self.mart_rollup()

    def mart_rollup(self) -> None:
        """The day's rollup rows for the dashboards."""
        dims = {**self.dims(), "dim_date": self.read("dim_date")}
        table = schemas.TABLES["mart_rollup"]
        rows = rollup.daily_rollup(marts.mart_sessions(self.read_day("fact_sessions"), dims))
        tables.write_partitioned(rows, self.path(table.name), table.partition, table.cluster)

    def lifetime_numbers(self) -> None:
        """Numbers the day's conversions over all history, from the counters of the day before."""
        counters, flat = f"{self.path('fact_conversions')}_counters", self.read("stg_events_flat")
        load = lifetime.load_day if lifetime.through(self.spark, counters) else lifetime.backfill
        load(self.spark, counters, f"{self.path('fact_conversions')}_lifetime", flat,
             self.params.run_date)

    def checks(self) -> DataFrame:
        """The day's quality results; they replace those of an earlier run of the day."""
        dims = {**self.dims(), "dim_date": self.read("dim_date")}
        flat, sessions = self.read_day("stg_events_flat"), self.read_day("stg_sessions")
        fact, day = self.read_day("fact_sessions"), self.params.run_date
        export = raw.scan_raw_day(raw.open_export(self.spark, self.export), day)
        results = (quality.stage_results(flat, sessions, day)
                   .unionByName(quality.olap_results(fact, dims, day))
                   .unionByName(quality.assertion_results(export, flat, sessions, fact, dims, day)))
        stamped = (self.stamp(results)
                   .withColumnRenamed("_etl_timestamp", "check_timestamp"))
        tables.write_partitioned(stamped, self.path("data_quality_log"), "check_date",
                                 schemas.TABLES["data_quality_log"].cluster)
        return raw.scan_partition(self.read("data_quality_log"), "check_date",
                                  self.params.run_date)

    def gate(self) -> None:
        """Stops the run when a stage table has no rows for the day."""
        for name in ("stg_events_flat", "stg_sessions"):
            if self.read_day(name).isEmpty():
                raise quality.QualityGateFailed(name)

    def summary(self) -> None:
        one = monitor.daily_summary(
            self.params.run_date, self.read_day("stg_events_flat"),
            self.read_day("stg_sessions"), self.read_day("fact_sessions"),
            self.read_day("fact_conversions"))
        tables.replace_safely(self.stamp(one).withColumnRenamed(
            "_etl_timestamp", "report_timestamp"), self.path("daily_summary"))

    def retention(self, years: int = V.RETENTION_YEARS) -> dict[str, int]:
        """Drops whole days past the retention time; returns how many per table."""
        cutoff = tables.retention_cutoff(self.params.as_of, years)
        return {name: tables.delete_before(self.spark, self.path(name),
                                           schemas.TABLES[name].partition, cutoff)
                for name in ("stg_events_flat", "stg_sessions", "fact_sessions")}

    # --- audit -----------------------------------------------------------------------

    def timed(self, step: Callable[[], object]) -> tuple[float, Exception | None]:
        start = time.monotonic()
        try:
            step()
        except Exception as exc:
            return time.monotonic() - start, exc
        return time.monotonic() - start, None

    def logged(self, task: str, step: Callable[[], object], counted: str | None = None) -> None:
        """Runs a step and appends its outcome, duration and row count to the run log."""
        seconds, error = self.timed(step)
        rows = self.read_day(counted).count() if counted and not error else 0
        self.log(task, rows, seconds, error)
        if error:
            raise error

    def logged_together(self, steps: dict[str, Callable[[], object]]) -> None:
        """Runs independent steps side by side, then logs them one by one."""
        results = side_by_side(self.spark, [lambda s=s: self.timed(s) for s in steps.values()])
        for task, (seconds, error) in zip(steps, results):
            self.log(task, 0, seconds, error)
        for _, error in results:
            if error:
                raise error

    def log(self, task: str, rows: int, seconds: float, error: Exception | None) -> None:
        now = self.params.run_ts or dt.datetime.combine(self.params.as_of, dt.time(2))
        line = [(self.run_id, self.params.run_date, JOB, task,
                 "failed" if error else "success", rows, 0, int(seconds),
                 str(error) if error else None, now)]
        tables.append_rows(self.spark.createDataFrame(line, schemas.ETL_RUN_LOG),
                           self.path("etl_run_log"), "run_date")


def merge_job(load: DailyLoad, name: str) -> None:
    """One incremental merge with its log line."""
    load.logged(name, lambda: load.fact(name), name)


def run_daily(spark: SparkSession, export: str, root: str, params: RunParams,
              reprocess_days: int | None = 1, lookback: int = 30) -> DailyLoad:
    """Export → stage → dimensions → facts → checks → summary, each step logged.

    With ``reprocess_days`` the days before the run date are loaded again up to the
    facts and their checks, oldest first, so late rows reach every table. With None they go back
    to the oldest shard of the look-back that is new or has changed since it was loaded.
    """
    load, prints = DailyLoad(spark, export, root, params), None
    load.logged("check_raw_data", load.check_raw)
    if reprocess_days is None:
        prints = load.fingerprints(lookback)
        oldest = min([*load.changed_days(prints), params.run_date])
        reprocess_days = (params.run_date - oldest).days + 1
    load.logged("stg_events_flat", lambda: load.stg_events_flat(reprocess_days),
                "stg_events_flat")
    load.logged("stg_sessions", lambda: load.stg_sessions(reprocess_days), "stg_sessions")
    load.logged("dim_date", load.dim_date)
    for back in range(reprocess_days - 1, -1, -1):
        day = replace(load, params=replace(
            params, run_date=params.run_date - dt.timedelta(days=back)))
        if back and day.read_day("stg_events_flat").isEmpty():
            continue
        steps = {name: lambda name=name, day=day: day.dimension(name) for name in D.DIMENSIONS}
        day.logged_together(steps if back else {
            "stg_users": lambda: load.stg_users(days=reprocess_days), **steps})
        for name in ("fact_sessions", "fact_events", "fact_conversions"):
            merge_job(day, name)
        day.logged("quality_gate", day.gate)
        day.logged("quality_checks", day.checks)
    load.logged("daily_summary", load.summary)
    if prints is not None:
        load.remember(prints)
    return load


def run_scheduled_checks(load: DailyLoad) -> list[tuple[str, bool]]:
    """The scheduled checks: stage first, then fact volume, then fact references.

    A group runs only when the one before it passed. Volumes pass from their expected
    minimum on.
    """
    flat, sessions = load.read_day("stg_events_flat"), load.read_day("stg_sessions")
    fact, dates = load.read_day("fact_sessions"), load.read("dim_date")
    values = quality.value_checks(flat, sessions, fact).select(
        "check_name", F.col("minimum_status").alias("status"))
    is_fact = F.col("check_name") == "check_fact_sessions_volume"
    rows = quality.stage_results(flat, sessions, load.params.run_date)
    zero = rows.where(F.col("assertion_name").isin(
        "events_without_session", "negative_session_duration")).select(
        F.concat(F.lit("check_"), "assertion_name").alias("check_name"), "status")
    orphan = quality.integrity(fact, dates, "dim_date").select(
        F.lit("check_orphan_sessions").alias("check_name"), "status")
    done: list[tuple[str, bool]] = []
    for group in (values.where(~is_fact).unionByName(zero), values.where(is_fact), orphan):
        outcome = [(r["check_name"], r["status"] == "PASS") for r in group.collect()]
        done += sorted(outcome)
        if not all(ok for _, ok in outcome):
            break
    return done


def run_quality(load: DailyLoad) -> int:
    """Exit code of the quality job: 1 when any check of the day failed."""
    return 1 if quality.failed_names(load.checks()) else 0
