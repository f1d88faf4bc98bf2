"""Dashboard metrics over the session mart; a session is one mart row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.functions.rates import percent, ratio, rounded_sum


def sessions_n() -> Column:
    return F.count(F.lit(1))


def measures(*names: str) -> list[Column]:
    """Named measures, each over all rows of a group."""
    n, conv = sessions_n(), F.sum("conversions")
    known = {
        "sessions": n, "conversions": conv, "leads": F.sum("leads"),
        "engaged_sessions": F.sum("engaged_sessions"),
        "conversion_rate": F.round(percent(conv, n), 2),
        "lead_rate": F.round(percent(F.sum("leads"), n), 2),
        "engaged_rate": F.round(percent(F.sum("engaged_sessions"), n), 2),
        "bounce_rate": F.round(F.lit(100.0) - percent(F.sum("engaged_sessions"), n), 2),
        "revenue_per_session": F.round(ratio(rounded_sum(F.col("total_conversion_value")), n), 4),
        "avg_duration_min": F.round(F.avg("session_duration_seconds") / 60, 4),
        "total_conversion_value": rounded_sum(F.col("total_conversion_value")),
    }
    return [known[name].alias(name) for name in names]


def since(mart: DataFrame, first: dt.date) -> DataFrame:
    return mart.where(F.col("session_date") >= F.lit(first))


def by(mart: DataFrame, dimensions: list[str], *names: str) -> DataFrame:
    return mart.groupBy(*dimensions).agg(*measures(*names))


def top(report: DataFrame, k: int, measure: str = "sessions", *ties: str) -> DataFrame:
    """The k largest rows; ties are broken by the given columns."""
    return report.orderBy(F.desc(measure), *[F.asc_nulls_first(t) for t in ties]).limit(k)


def kpi_overview(mart: DataFrame) -> DataFrame:
    return mart.agg(*measures("sessions", "conversions", "conversion_rate", "avg_duration_min",
                              "leads", "engaged_sessions"))


def rates(mart: DataFrame, dimension: str) -> DataFrame:
    return by(mart, [dimension], "conversion_rate", "lead_rate", "engaged_rate",
              "revenue_per_session", "bounce_rate", "avg_duration_min")


def sessions_by_date(mart: DataFrame) -> DataFrame:
    return by(mart, ["session_date"], "sessions", "conversions").orderBy(F.desc("session_date"))


def sessions_by_channel(mart: DataFrame) -> DataFrame:
    return by(mart, ["channel_group"], "sessions", "conversions",
              "conversion_rate").orderBy(F.desc("sessions"))


def sessions_by_device(mart: DataFrame) -> DataFrame:
    return by(mart, ["device_category"], "sessions", "conversions", "conversion_rate")


def mobile_vs_desktop(mart: DataFrame) -> DataFrame:
    kinds = {"mobile": F.col("device_category") == "mobile",
             "desktop": F.col("device_category") == "desktop"}
    out = []
    for name, cond in kinds.items():
        hit = F.count_if(cond)
        out += [hit.alias(f"{name}_sessions"),
                F.round(percent(F.sum(F.when(cond, F.col("conversions"))), hit), 2)
                .alias(f"{name}_conversion_rate")]
    return mart.agg(*out)


def top_countries(mart: DataFrame, k: int = 10) -> DataFrame:
    report = by(mart, ["country"], "sessions", "conversions", "conversion_rate")
    return top(report, k, "sessions", "country")


def country_kpis(mart: DataFrame) -> DataFrame:
    """Number of countries and the one with most sessions, from one small grouping."""
    per = by(mart.where(F.col("country").isNotNull()), ["country"], "sessions")
    best = F.min(F.struct((-F.col("sessions")).alias("n"), "country"))
    return per.agg(F.count(F.lit(1)).alias("countries"), best.alias("b")).select(
        "countries", F.col("b.country").alias("top_country"),
        (-F.col("b.n")).alias("top_country_sessions"))


def channel_date_heatmap(mart: DataFrame) -> DataFrame:
    return by(mart, ["channel_group", "session_date"], "sessions", "conversions")


def channel_comparison(mart: DataFrame) -> DataFrame:
    return by(mart, ["channel_group"], "sessions", "conversions", "leads")


def channel_funnel(mart: DataFrame) -> DataFrame:
    """Sessions, engaged sessions and conversions per channel as three steps."""
    wide = by(mart, ["channel_group"], "sessions", "engaged_sessions", "conversions")
    steps = F.explode(F.array(
        F.struct(F.lit(1).cast("bigint").alias("step"), F.lit("sessions").alias("step_name"),
                 F.col("sessions").alias("value"), F.col("sessions").alias("previous")),
        F.struct(F.lit(2).cast("bigint").alias("step"),
                 F.lit("engaged_sessions").alias("step_name"),
                 F.col("engaged_sessions").alias("value"), F.col("sessions").alias("previous")),
        F.struct(F.lit(3).cast("bigint").alias("step"), F.lit("conversions").alias("step_name"),
                 F.col("conversions").alias("value"),
                 F.col("engaged_sessions").alias("previous"))))
    return wide.select("channel_group", steps.alias("s")).select(
        "channel_group", "s.step", "s.step_name", "s.value",
        F.round(percent(F.col("s.value"), F.col("s.previous")), 2).alias("step_rate"))


CAMPAIGN = ["utm_campaign", "utm_source", "utm_medium"]


def campaign_performance(mart: DataFrame) -> DataFrame:
    return by(mart, CAMPAIGN, "sessions", "conversions", "conversion_rate",
              "total_conversion_value")


def active_campaigns(mart: DataFrame, unknown: str) -> DataFrame:
    named = mart.where(F.col("utm_campaign") != unknown)
    return named.agg(F.count_distinct("utm_campaign").alias("active_campaigns"))


def best_campaign(mart: DataFrame, unknown: str) -> DataFrame:
    named = by(mart.where(F.col("utm_campaign") != unknown), ["utm_campaign"], "sessions",
               "conversions")
    return top(named, 1, "conversions", "utm_campaign")


def top_landing_pages(mart: DataFrame, k: int = 20) -> DataFrame:
    report = by(mart, ["landing_page"], "sessions", "conversions")
    return top(report, k, "sessions", "landing_page")


def sessions_by_region(mart: DataFrame) -> DataFrame:
    return by(mart, ["country", "region"], "sessions", "conversions")


def top_cities(mart: DataFrame, k: int = 20) -> DataFrame:
    return top(by(mart, ["city"], "sessions", "conversions"), k, "sessions", "city")


def conversion_rate_by_os(mart: DataFrame) -> DataFrame:
    return by(mart, ["operating_system"], "conversion_rate")


def detail_table(mart: DataFrame) -> DataFrame:
    return by(mart, ["channel_group", "utm_campaign", "country"], "sessions", "conversions")


def channel_type_table(mart: DataFrame) -> DataFrame:
    return by(mart, ["channel_group", "channel_type"], "sessions", "conversions",
              "conversion_rate")


def monthly_sessions(mart: DataFrame) -> DataFrame:
    return by(mart, ["year", "month"], "sessions", "conversions")


def mart_rows(mart: DataFrame) -> DataFrame:
    return mart.agg(sessions_n().alias("total_sessions"))


def apply_filters(mart: DataFrame, first: dt.date | None = None, last: dt.date | None = None,
                  channels: list[str] | None = None, countries: list[str] | None = None,
                  devices: list[str] | None = None,
                  contains: dict[str, str] | None = None) -> DataFrame:
    """The global dashboard filters; the date range prunes partitions of the fact."""
    if first is not None:
        mart = mart.where(F.col("session_date") >= F.lit(first))
    if last is not None:
        mart = mart.where(F.col("session_date") <= F.lit(last))
    for column, values in (("channel_group", channels), ("country", countries),
                           ("device_category", devices)):
        if values:
            mart = mart.where(F.col(column).isin(values))
    for column, part in (contains or {}).items():
        mart = mart.where(F.col(column).contains(part))
    return mart
