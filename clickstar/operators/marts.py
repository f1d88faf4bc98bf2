"""Marts: facts opened up with the attributes of their dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.operators import dims as D

DATE_ATTRIBUTES = ["year", "quarter", "month", "week", "day_name"]
SHOWN = {
    "dim_device": ["device_category", "device_type_group", "operating_system"],
    "dim_geo": ["country", "region", "city", "region_group"],
    "dim_campaign": ["utm_source", "utm_medium", "utm_campaign", "campaign_full_name"],
    "dim_channel": ["channel_group", "channel_type", "source", "medium"],
}


def open_star(fact: DataFrame, dims: dict[str, DataFrame], date_attributes: list[str]) -> DataFrame:
    """Left-joins the calendar and every shown dimension on its key.

    Only the calendar is broadcast by hint: its size is fixed. The others are
    broadcast by the planner when their written size allows.
    """
    out = fact.join(F.broadcast(dims["dim_date"].select("date_key", *date_attributes)),
                    "date_key", "left")
    for name, shown in SHOWN.items():
        key = D.DIMENSIONS[name].key
        out = out.join(dims[name].select(key, *shown), key, "left")
    return out


def flag(cond: Column) -> Column:
    """1 where the condition holds, else 0, also for NULL."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def mart_sessions(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    dates = [*DATE_ATTRIBUTES, "is_weekend"]
    return open_star(fact, dims, dates).select(
        "session_id", "session_date", "user_pseudo_id", "user_id", *dates,
        *[c for shown in SHOWN.values() for c in shown],
        "session_start_timestamp", "session_end_timestamp", "session_duration_seconds",
        "events_count", "pageviews", "has_conversion", "has_lead", "session_engaged",
        "total_conversion_value", "total_purchase_revenue", "landing_page", "exit_page",
        flag(F.col("has_conversion")).alias("conversions"),
        flag(F.col("has_lead")).alias("leads"),
        flag(F.col("session_engaged") > 0).alias("engaged_sessions"))


def mart_conversions(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Also joins the event types, of which no column is shown."""
    types = dims["dim_event_type"].select("event_type_key")
    opened = open_star(fact, dims, DATE_ATTRIBUTES).join(types, "event_type_key", "left")
    return opened.select(
        "conversion_id", "conversion_date", "conversion_timestamp", "session_id",
        "user_pseudo_id", "user_id", *DATE_ATTRIBUTES,
        *[c for shown in SHOWN.values() for c in shown],
        "conversion_type", "event_name", "lead_id", "conversion_value", "purchase_revenue",
        "is_first_conversion", "conversion_number",
        flag(F.col("conversion_type") == "lead").alias("leads"),
        flag(F.col("conversion_type") == "purchase").alias("purchases"))


def region_filter(mart: DataFrame, region: str) -> DataFrame:
    """The rows a reader restricted to one region may see."""
    return mart.where(F.col("region") == region)
