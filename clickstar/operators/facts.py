"""Facts: stage rows with the keys of their dimensions.

Dimension sides carry no broadcast hint. They are written tables, so the planner
knows their size and broadcasts them when they are below its threshold; a larger
one is shuffled and its hot keys are split at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.functions import keys
from clickstar.operators import dims as D
from clickstar.operators.numbering import number_rows
from clickstar.operators.stage import as_amount

SESSION_LOOKUPS = {
    "dim_device": {"device_category": ["device_category"], "operating_system": ["device_os"]},
    "dim_geo": {"country": ["country"], "region": ["region"], "city": ["city"]},
    "dim_campaign": {"utm_source": ["source"], "utm_medium": ["medium"],
                     "utm_campaign": ["campaign"]},
    "dim_channel": {"source": ["source"], "medium": ["medium"]},
}

EVENT_LOOKUPS = {
    "dim_device": SESSION_LOOKUPS["dim_device"],
    "dim_geo": SESSION_LOOKUPS["dim_geo"],
    "dim_campaign": {c: [c] for c in ("utm_source", "utm_medium", "utm_campaign")},
    "dim_channel": {"source": ["utm_source", "traffic_source_source"],
                    "medium": ["utm_medium", "traffic_source_medium"]},
    "dim_event_type": {"event_name": ["event_name"]},
}


def attach_keys(rows: DataFrame, dims: dict[str, DataFrame],
                lookups: dict[str, dict[str, list[str]]], conformed: bool) -> DataFrame:
    """Left-joins each dimension on its lookup columns and keeps its key only."""
    for name, values in lookups.items():
        dim = D.DIMENSIONS[name]
        side = dims[name].select(
            dim.key, *[F.col(c).alias(f"_{name}_{c}") for c in values])

        def equal(column: str, sources: list[str], name: str = name) -> Column:
            value = F.coalesce(*sources)
            if name != "dim_event_type":
                value = keys.known(value)
            return value == F.col(f"_{name}_{column}")

        cond = reduce(lambda a, b: a & b, [equal(c, s) for c, s in values.items()])
        rows = rows.join(side, cond, "left").drop(*[f"_{name}_{c}" for c in values])
        if conformed:
            rows = rows.withColumn(dim.key, F.coalesce(dim.key, D.unknown_key(dim)))
    return rows


def fact_sessions(session_rows: DataFrame, dims: dict[str, DataFrame],
                  conformed: bool = False) -> DataFrame:
    """Sessions with their dimension keys; the conformed form keeps the whole session grain."""
    keyed = attach_keys(session_rows, dims, SESSION_LOOKUPS, conformed)
    return keyed.select(
        "session_id", "session_date", "user_pseudo_id", "user_id",
        F.col("session_date").alias("date_key"), "device_key", "geo_key", "campaign_key",
        "channel_key", "session_start_timestamp", "session_end_timestamp",
        "session_duration_seconds", "events_count", "pageviews",
        F.col("has_conversion").cast("boolean").alias("has_conversion"),
        F.col("has_lead").cast("boolean").alias("has_lead"), "session_engaged",
        "total_conversion_value", "total_purchase_revenue", "landing_page", "exit_page",
        *(["ga_session_id"] if conformed else []))


def fact_events(flat: DataFrame, dims: dict[str, DataFrame], conformed: bool = False,
                lenient: bool = False) -> DataFrame:
    """Events with their dimension keys."""
    keyed = attach_keys(flat, dims, EVENT_LOOKUPS, conformed)
    if conformed:
        identity = keys.row_identity(F.col("user_pseudo_id"), F.col("session_id"),
                                     F.col("event_timestamp"), F.col("event_name"),
                                     F.col("src_event_id"))
        at = F.timestamp_micros("event_timestamp")
    else:
        identity = keys.event_id(F.col("session_id"), F.col("event_timestamp"),
                                 F.col("event_name"))
        at = F.col("event_timestamp_date")
    return keyed.select(
        identity.alias("event_id"), F.col("event_date_partition").alias("event_date"),
        at.alias("event_timestamp"), "session_id", "user_pseudo_id", "user_id",
        F.col("event_date_partition").alias("date_key"), "device_key", "geo_key",
        "campaign_key", "channel_key", "event_type_key", "event_name", "page_location",
        "page_title", "is_conversion_event", "is_lead_event",
        as_amount(F.col("conversion_value"), lenient).alias("conversion_value"),
        "purchase_revenue")


def conversions(flat: DataFrame) -> DataFrame:
    """Conversion and lead events."""
    return flat.where(F.col("is_conversion_event") | F.col("is_lead_event"))


def numbered_conversions(flat: DataFrame, lifetime: bool = False) -> DataFrame:
    """Conversions numbered per user: within the day, or over all days given."""
    group = ["user_pseudo_id"] if lifetime else ["event_date_partition", "user_pseudo_id"]
    return (number_rows(conversions(flat), group, "conversion_number")
            .withColumn("is_first_conversion", F.col("conversion_number") == 1))


def conversion_type() -> Column:
    return (F.when(F.col("is_lead_event"), "lead")
            .when(F.col("is_conversion_event"), "purchase").otherwise("other"))


def fact_conversions(flat: DataFrame, dims: dict[str, DataFrame], conformed: bool = False,
                     lifetime: bool = False, lenient: bool = False) -> DataFrame:
    """Conversions with number and dimension keys; numbered before any join."""
    keyed = attach_keys(numbered_conversions(flat, lifetime), dims, EVENT_LOOKUPS, conformed)
    if conformed:
        identity = keys.row_identity(F.col("user_pseudo_id"), F.col("session_id"),
                                     F.col("event_timestamp"), F.col("event_name"),
                                     F.col("src_event_id"))
        at = F.timestamp_micros("event_timestamp")
    else:
        at = F.col("event_timestamp_date")
        identity = keys.conversion_id(F.col("session_id"), at, F.col("event_name"))
    return keyed.select(
        identity.alias("conversion_id"),
        F.col("event_date_partition").alias("conversion_date"),
        at.alias("conversion_timestamp"), "session_id", "user_pseudo_id", "user_id",
        F.col("event_date_partition").alias("date_key"), "device_key", "geo_key",
        "campaign_key", "channel_key", "event_type_key",
        conversion_type().alias("conversion_type"), "event_name", "lead_id",
        as_amount(F.col("conversion_value"), lenient).alias("conversion_value"),
        "purchase_revenue", "is_first_conversion", "conversion_number")
