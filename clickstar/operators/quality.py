"""Quality checks as data: each check is a few aggregates and a rule over them.

Checks on one table run in one pass. Results are rows of ``data_quality_log``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar.functions.event_params import has_duplicate_keys


class QualityGateFailed(RuntimeError):
    """A gate found failing checks."""


def rows() -> Column:
    return F.count(F.lit(1))


def status(passed: Column) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))


def within_tolerance(value: Column, expected: float, tolerance: float) -> Column:
    return value.between(expected * (1 - tolerance), expected * (1 + tolerance))


def at_least(value: Column, minimum: float) -> Column:
    return value >= F.lit(minimum)


@dataclass(frozen=True)
class Check:
    """``metrics`` are aggregates over one table; ``passes`` is a rule over them."""

    name: str
    table: str
    metrics: Callable[[], dict[str, Column]]
    passes: Callable[[], Column]

    def report(self, day_rows: DataFrame) -> DataFrame:
        """One row: the check's name, its metrics and its status."""
        metrics = self.metrics()
        one = day_rows.agg(*[c.alias(n) for n, c in metrics.items()])
        return one.select(F.lit(self.name).alias("assertion_name"), *metrics,
                          status(self.passes()).alias("status"))


def _zero(name: str) -> Callable[[], Column]:
    return lambda: F.col(name) == 0


def _some(name: str) -> Callable[[], Column]:
    return lambda: F.col(name) > 0


def _no_session() -> Column:
    return F.count_if(F.col("ga_session_id").isNull())


def _negative() -> Column:
    return F.count_if(F.col("session_duration_seconds") < 0)


STAGE_CHECKS = [
    Check("stage_events_volume", "stg_events_flat",
          lambda: {"events_count": rows()}, _some("events_count")),
    Check("stage_events_missing_session_id", "stg_events_flat",
          lambda: {"events_without_session": _no_session(), "events_total": rows()},
          lambda: F.col("events_without_session")
          < F.col("events_total") * F.lit(V.MISSING_SESSION_SHARE)),
    Check("stage_sessions_volume", "stg_sessions",
          lambda: {"sessions_count": rows()}, _some("sessions_count")),
    Check("stage_sessions_negative_duration", "stg_sessions",
          lambda: {"sessions_negative_duration": _negative()},
          _zero("sessions_negative_duration")),
    Check("stage_sessions_events_distribution", "stg_sessions",
          lambda: {"avg_events_per_session": F.avg("events_count"),
                   "stddev_events_per_session": F.stddev_samp("events_count")},
          lambda: F.col("avg_events_per_session").between(*V.EVENTS_PER_SESSION_RANGE)),
    Check("stage_sessions_unique", "stg_sessions",
          lambda: {"total_sessions": rows(),
                   "unique_sessions": F.count_distinct("session_id")},
          lambda: F.col("total_sessions") == F.col("unique_sessions")),
    Check("stage_events_critical_fields", "stg_events_flat",
          lambda: {"total_events": rows(),
                   "null_event_name": F.count_if(F.col("event_name").isNull()),
                   "null_user_id": F.count_if(F.col("user_pseudo_id").isNull()),
                   "null_timestamp": F.count_if(F.col("event_timestamp").isNull())},
          lambda: (F.col("null_event_name") + F.col("null_user_id")
                   + F.col("null_timestamp")) == 0),
]

VOLUME_CHECK = Check("olap_fact_sessions_volume", "fact_sessions",
                     lambda: {"sessions_count": rows()}, _some("sessions_count"))

UNIQUE_CHECKS = [
    Check("olap_dim_date_unique_keys", "dim_date",
          lambda: {"total_rows": rows(), "unique_keys": F.count_distinct("date_key")},
          lambda: F.col("total_rows") == F.col("unique_keys")),
    Check("olap_dim_device_unique_keys", "dim_device",
          lambda: {"total_rows": rows(), "unique_keys": F.count_distinct("device_key")},
          lambda: F.col("total_rows") == F.col("unique_keys")),
]

CHECKS = {c.name: c for c in [*STAGE_CHECKS, VOLUME_CHECK, *UNIQUE_CHECKS]}

# Key column of each dimension whose references are checked.
REFERENCES = {"dim_date": "date_key", "dim_device": "device_key", "dim_geo": "geo_key",
              "dim_channel": "channel_key"}


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension does not hold; a NULL key is one."""
    return fact.join(dim.select(key), key, "left_anti")


def integrity(fact: DataFrame, dim: DataFrame, name: str) -> DataFrame:
    """One row: how many fact rows point nowhere."""
    lost = orphans(fact, dim, REFERENCES[name]).agg(rows().alias("orphan_sessions"))
    return lost.select(F.lit(f"olap_fact_sessions_{name}_integrity").alias("assertion_name"),
                       "orphan_sessions", status(F.col("orphan_sessions") == 0).alias("status"))


def orphan_counts(fact: DataFrame, dims: dict[str, DataFrame], names: list[str],
                  *group: str) -> DataFrame:
    """Orphans against several dimensions in one pass over the fact."""
    for name in names:
        key = REFERENCES[name]
        side = dims[name].select(key).distinct().withColumn(f"_has_{name}", F.lit(True))
        fact = fact.join(side, key, "left")
    return fact.groupBy(*group).agg(
        rows().alias("fact_sessions_volume"),
        *[F.count_if(F.col(f"_has_{n}").isNull()).alias(f"{n}_integrity") for n in names])


def consistency(fact: DataFrame, stage: DataFrame) -> DataFrame:
    """One row: do fact and stage hold about as many rows for the day."""
    both = fact.select(F.lit(True).alias("is_fact")).unionByName(
        stage.select(F.lit(False).alias("is_fact")))
    counts = both.agg(F.count_if("is_fact").alias("fact_count"),
                      F.count_if(~F.col("is_fact")).alias("stage_count"))
    gap = F.abs(F.col("fact_count") - F.col("stage_count"))
    return counts.select(
        F.lit("olap_fact_sessions_consistency").alias("assertion_name"),
        "fact_count", "stage_count", status(gap <= V.FACT_STAGE_TOLERANCE).alias("status"))


def not_empty(dims: dict[str, DataFrame]) -> DataFrame:
    """One row: row counts of the four checked dimensions."""
    names = list(REFERENCES)
    tagged = [dims[n].select(F.lit(n).alias("d")) for n in names]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other)
    counts = union.agg(*[F.count_if(F.col("d") == n).alias(f"{n}_count") for n in names])
    return counts.select(F.lit("olap_dimensions_not_empty").alias("assertion_name"),
                         *[f"{n}_count" for n in names],
                         status(F.least(*[f"{n}_count" for n in names]) > 0).alias("status"))


def duplicate_param_keys(raw: DataFrame) -> DataFrame:
    """One row: events that carry one parameter key twice."""
    bad = raw.agg(F.count_if(has_duplicate_keys()).alias("events_with_duplicate_keys"))
    return bad.select(F.lit("raw_duplicate_param_keys").alias("assertion_name"),
                      "events_with_duplicate_keys",
                      status(F.col("events_with_duplicate_keys") == 0).alias("status"))


def bad_amounts(flat: DataFrame) -> DataFrame:
    """One row: conversion values that are no numbers."""
    text = F.col("conversion_value")
    bad = flat.agg(F.count_if(text.isNotNull() & text.try_cast("double").isNull())
                   .alias("unreadable_values"))
    return bad.select(F.lit("stage_events_conversion_value").alias("assertion_name"),
                      "unreadable_values",
                      status(F.col("unreadable_values") == 0).alias("status"))


def value_checks(flat: DataFrame, sessions: DataFrame, fact: DataFrame) -> DataFrame:
    """Counts of the scheduled checks with both readings of their expected value."""
    named = {"check_events_volume": (flat, V.EXPECTED_EVENTS),
             "check_sessions_volume": (sessions, V.EXPECTED_SESSIONS),
             "check_fact_sessions_volume": (fact, V.EXPECTED_FACTS)}
    out = None
    for name, (table, expected) in named.items():
        value = F.col("value")
        one = table.agg(rows().alias("value")).select(
            F.lit(name).alias("check_name"), "value",
            F.lit(expected).cast("bigint").alias("pass_value"),
            status(within_tolerance(value, expected, V.VALUE_TOLERANCE)).alias("tolerance_status"),
            status(at_least(value, expected)).alias("minimum_status"))
        out = one if out is None else out.unionByName(one)
    return out


def truthy(table: DataFrame, name: str) -> DataFrame:
    """Gate row: passes when the count is not zero."""
    return table.agg(rows().alias("value")).select(
        F.lit(name).alias("check_name"), "value", (F.col("value") > 0).alias("passed"))


STAGE_EVENT_METRICS = {"events_volume": rows, "events_without_session": _no_session}
STAGE_SESSION_METRICS = {"sessions_volume": rows, "negative_session_duration": _negative}
OLAP_NAMES = ["dim_date", "dim_device"]
MUST_BE_POSITIVE = ["events_volume", "sessions_volume", "fact_sessions_volume"]


def _stack(wide: DataFrame, layer: str, names: list[str], check_date: Column) -> DataFrame:
    """One log row per metric column."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(n).alias("assertion_name"), F.col(n).cast("bigint").alias("count"))
        for n in names])).alias("m")
    long = wide.select(check_date.alias("check_date"), pairs)
    count, name = F.col("m.count"), F.col("m.assertion_name")
    passed = F.when(name.isin(MUST_BE_POSITIVE), count > 0).otherwise(count == 0)
    return long.select("check_date", F.lit(layer).alias("layer"), name.alias("assertion_name"),
                       status(passed).alias("status"), count.alias("count"))


def _all_metrics(table: DataFrame, metrics: dict, *group: str) -> DataFrame:
    return table.groupBy(*group).agg(*[make().alias(n) for n, make in metrics.items()])


def stage_results(flat: DataFrame, sessions: DataFrame, day: dt.date) -> DataFrame:
    date = F.lit(day)
    return _stack(_all_metrics(flat, STAGE_EVENT_METRICS), "stage", list(STAGE_EVENT_METRICS),
                  date).unionByName(
        _stack(_all_metrics(sessions, STAGE_SESSION_METRICS), "stage",
               list(STAGE_SESSION_METRICS), date))


def olap_results(fact: DataFrame, dims: dict[str, DataFrame], day: dt.date) -> DataFrame:
    counts = orphan_counts(fact, dims, OLAP_NAMES)
    return _stack(counts, "olap",
                  ["fact_sessions_volume", *[f"{n}_integrity" for n in OLAP_NAMES]], F.lit(day))


def assertion_results(raw: DataFrame, flat: DataFrame, sessions: DataFrame, fact: DataFrame,
                      dims: dict[str, DataFrame], day: dt.date) -> DataFrame:
    """Every assertion of a day as a log row; ``count`` is the assertion's first number.

    Names differ from those of the monitoring rows, so both can stand in one log.
    """
    reports = [(c.table.split("_")[0].replace("stg", "stage").replace("fact", "olap")
                .replace("dim", "olap"), c.report({
                    "stg_events_flat": flat, "stg_sessions": sessions, "fact_sessions": fact,
                    **dims}[c.table]))
               for c in CHECKS.values()]
    reports += [("olap", integrity(fact, dims[n], n)) for n in REFERENCES]
    reports += [("olap", consistency(fact, sessions)), ("olap", not_empty(dims)),
                ("raw", duplicate_param_keys(raw)), ("stage", bad_amounts(flat))]
    out = None
    for layer, report in reports:
        number = next(c for c in report.columns if c not in ("assertion_name", "status"))
        one = report.select(F.lit(day).alias("check_date"), F.lit(layer).alias("layer"),
                            "assertion_name", "status", F.col(number).cast("bigint").alias("count"))
        out = one if out is None else out.unionByName(one)
    return out


def quality_history(flat: DataFrame, sessions: DataFrame, fact: DataFrame,
                    dims: dict[str, DataFrame]) -> DataFrame:
    """The same log rows for every day that has data."""
    events = _all_metrics(flat, STAGE_EVENT_METRICS, "event_date_partition")
    sess = _all_metrics(sessions, STAGE_SESSION_METRICS, "session_date")
    facts = orphan_counts(fact, dims, OLAP_NAMES, "session_date")
    return (_stack(events, "stage", list(STAGE_EVENT_METRICS), F.col("event_date_partition"))
            .unionByName(_stack(sess, "stage", list(STAGE_SESSION_METRICS),
                                F.col("session_date")))
            .unionByName(_stack(facts, "olap", ["fact_sessions_volume",
                                                *[f"{n}_integrity" for n in OLAP_NAMES]],
                                F.col("session_date"))))


def failed_names(results: DataFrame) -> list[str]:
    """Names of failing checks: as many as there are checks at most."""
    bad = results.where(F.col("status") == "FAIL").select("assertion_name").distinct()
    return sorted(r[0] for r in bad.collect())
