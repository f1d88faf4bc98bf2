"""Declared schemas and the physical layout of every warehouse table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def struct(columns: str) -> T.StructType:
    """A flat schema from ``name type`` pairs; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PARAM_VALUE = struct(
    "string_value string, int_value bigint, float_value double, double_value double")
PARAM = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PARAM_VALUE)])

RAW_EVENTS = T.StructType([
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("src_event_id", T.LongType()),
    T.StructField("event_params", T.ArrayType(PARAM)),
    T.StructField("device", struct(
        "category string, mobile_brand_name string, mobile_model_name string, "
        "operating_system string, operating_system_version string")),
    T.StructField("geo", struct(
        "country string, region string, city string, continent string")),
    T.StructField("traffic_source", struct(
        "name string, medium string, source string")),
    T.StructField("ecommerce", struct(
        "total_item_quantity bigint, purchase_revenue double, purchase_revenue_currency string")),
    T.StructField("event_date", T.StringType()),
])

FACT_SESSIONS = struct("""
    session_id string, session_date date, user_pseudo_id string, user_id string,
    date_key date, device_key string, geo_key string, campaign_key string, channel_key string,
    session_start_timestamp timestamp, session_end_timestamp timestamp,
    session_duration_seconds bigint, events_count bigint, pageviews bigint,
    has_conversion boolean, has_lead boolean, session_engaged bigint,
    total_conversion_value double, total_purchase_revenue double,
    landing_page string, exit_page string, ga_session_id bigint, _etl_timestamp timestamp""")

FACT_EVENTS = struct("""
    event_id string, event_date date, event_timestamp timestamp, session_id string,
    user_pseudo_id string, user_id string, date_key date, device_key string, geo_key string,
    campaign_key string, channel_key string, event_type_key string, event_name string,
    page_location string, page_title string, is_conversion_event boolean, is_lead_event boolean,
    conversion_value double, purchase_revenue double, _etl_timestamp timestamp""")

FACT_CONVERSIONS = struct("""
    conversion_id string, conversion_date date, conversion_timestamp timestamp,
    session_id string, user_pseudo_id string, user_id string, date_key date, device_key string,
    geo_key string, campaign_key string, channel_key string, event_type_key string,
    conversion_type string, event_name string, lead_id string, conversion_value double,
    purchase_revenue double, is_first_conversion boolean, conversion_number bigint,
    _etl_timestamp timestamp""")

ETL_RUN_LOG = struct("""
    run_id string, run_date date, dag_id string, task_id string, status string,
    rows_processed bigint, bytes_processed bigint, duration_seconds bigint,
    error_message string, run_timestamp timestamp""")

DATA_QUALITY_LOG = struct("""
    check_date date, layer string, assertion_name string, status string, count bigint,
    check_timestamp timestamp""")


@dataclass(frozen=True)
class Table:
    """Layer, partition column, sort order inside files, lookup columns and description of a table."""

    name: str
    layer: str
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    schema: T.StructType | None = None
    description: str = ""
    merge_keys: tuple[str, ...] = ()
    update_columns: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ()


_ALL = [
    Table("stg_events_flat", "stage", "event_date_partition",
          ("event_name", "user_pseudo_id", "session_id"),
          description="One row per event, parameters and nested fields as columns",
          lookups=("user_pseudo_id", "session_id")),
    Table("stg_sessions", "stage", "session_date",
          ("session_id", "source", "medium", "has_conversion"),
          description="One row per session, day and user", lookups=("user_pseudo_id", "session_id")),
    Table("stg_users", "stage", "user_first_seen_date",
          ("user_pseudo_id", "primary_country", "primary_device_category"),
          description="One row per user over the look-back"),
    Table("dim_date", "olap", description="Calendar"),
    Table("dim_device", "olap", cluster=("device_key",), description="Devices"),
    Table("dim_geo", "olap", cluster=("geo_key",), description="Places"),
    Table("dim_campaign", "olap", cluster=("campaign_key",), description="Campaign parameters"),
    Table("dim_channel", "olap", cluster=("channel_key",), description="Marketing channels"),
    Table("dim_event_type", "olap", cluster=("event_type_key",), description="Event types"),
    Table("fact_sessions", "olap", "session_date",
          ("date_key", "channel_key", "has_conversion"), FACT_SESSIONS,
          "One row per session",
          ("session_id", "session_date", "user_pseudo_id", "user_id", "ga_session_id"),
          ("session_start_timestamp", "session_end_timestamp", "session_duration_seconds",
           "events_count", "pageviews", "has_conversion", "has_lead", "session_engaged",
           "total_conversion_value", "total_purchase_revenue", "landing_page", "exit_page",
           "_etl_timestamp")),
    Table("fact_events", "olap", "event_date",
          ("session_id", "event_name", "event_timestamp"), FACT_EVENTS,
          "One row per event",
          ("event_id", "event_date"),
          ("event_timestamp", "page_location", "page_title", "is_conversion_event",
           "is_lead_event", "conversion_value", "purchase_revenue", "_etl_timestamp")),
    Table("fact_conversions", "olap", "conversion_date",
          ("date_key", "channel_key", "conversion_type"), FACT_CONVERSIONS,
          "One row per conversion or lead",
          ("conversion_id", "conversion_date"),
          ("conversion_timestamp", "conversion_type", "lead_id", "conversion_value",
           "purchase_revenue", "is_first_conversion", "conversion_number", "_etl_timestamp")),
    Table("mart_rollup", "olap", "session_date", ("tile_set",),
          description="Sums and sketches per day and dashboard tile set"),
    Table("etl_run_log", "monitoring", "run_date", ("dag_id", "status", "run_timestamp"),
          ETL_RUN_LOG, "Audit trail of load steps"),
    Table("data_quality_log", "monitoring", "check_date", ("layer", "assertion_name"),
          DATA_QUALITY_LOG, "Results of quality checks"),
    Table("daily_summary", "monitoring", description="Row counts of the last run day"),
]
TABLES = {t.name: t for t in _ALL}
LAYERS = ("stage", "olap", "monitoring")
