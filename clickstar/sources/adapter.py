"""Turns the supplied ``events`` table into a nested export and two operational logs.

The supplied tables hold no nested export, run log or query log, so each is
derived row by row from ``events``: a projection, no shuffle. Every value follows
from event id ``e``, user id ``u``, time, type, value ``v`` and the integer ``k``
in ``props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _base(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS e", "user_id AS u", "CAST(ts AS TIMESTAMP) AS at",
        "unix_micros(CAST(ts AS TIMESTAMP)) AS us", "event_type AS kind", "value AS v",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")


def _pick(index: str, *values: str) -> str:
    """The list entry at ``index``, NULL past its end."""
    names = ", ".join(f"'{v}'" for v in values)
    return f"get(array({names}), CAST({index} AS INT))"


EVENT_NAME = """CASE kind
    WHEN 'view' THEN if(e % 3 = 0, 'scroll', 'page_view')
    WHEN 'click' THEN CASE e % 4 WHEN 0 THEN 'file_download' WHEN 1 THEN 'search'
        ELSE 'click' END
    WHEN 'purchase' THEN CASE e % 5 WHEN 0 THEN 'add_to_cart' WHEN 1 THEN 'conversion'
        ELSE 'purchase' END
    WHEN 'signup' THEN CASE e % 3 WHEN 0 THEN 'generate_lead' WHEN 1 THEN 'form_submit'
        ELSE 'contact' END
    ELSE 'exception' END"""

_SITE = _pick("k % 3", "www.a.com", "shop.a.com", "b.org")
_SOURCE = _pick("k % 6", "google", "bing", "facebook", "newsletter", "partner", "twitter")
_MEDIUM = _pick("k % 7", "cpc", "organic", "social", "email", "referral", "display")

# (key, field that holds the value, value, condition under which it is present)
_PARAMS = [
    ("ga_session_id", "int_value", "us div 43200000000 * 43200", "e % 97 <> 0"),
    ("page_location", "string_value",
     f"if(e % 13 = 0, 'app://home', concat('https://', {_SITE}, '/p', k % 20))", "e % 11 <> 0"),
    ("page_title", "string_value", "concat('Page ', k % 20)", "true"),
    ("page_referrer", "string_value", "'https://ref.example/'", "k % 5 = 0"),
    ("utm_source", "string_value", _SOURCE, "k < 60"),
    ("utm_medium", "string_value", _MEDIUM, "k < 60 AND k % 7 <> 6"),
    ("utm_campaign", "string_value", "concat('c', k % 5)", "k < 60 AND k % 10 <> 0"),
    ("utm_term", "string_value", "concat('t', k % 2)", "k < 60 AND k % 3 = 0"),
    ("utm_content", "string_value", "'banner'", "k < 60 AND k % 4 = 0"),
    ("lead_id", "string_value", "concat('L', e)",
     "event_name IN ('generate_lead', 'form_submit', 'contact')"),
    ("conversion_value", "string_value", "CAST(v AS STRING)", "kind = 'purchase'"),
    ("session_engaged", "int_value", "e % 2", "true"),
]


def _param(key: str, field: str, value: str, present: str) -> str:
    fields = {"string_value": "STRING", "int_value": "BIGINT", "float_value": "DOUBLE",
              "double_value": "DOUBLE"}
    slots = ", ".join(f"'{name}', CAST({value if name == field else 'NULL'} AS {kind})"
                      for name, kind in fields.items())
    entry = f"named_struct('key', '{key}', 'value', named_struct({slots}))"
    return f"if({present}, array({entry}), array())"


def raw_export(events: DataFrame) -> DataFrame:
    """The nested export: one row per event, keyed parameters in an array."""
    params = ", ".join(_param(*p) for p in _PARAMS)
    bought = "event_name = 'purchase'"
    return _base(events).selectExpr("*", f"{EVENT_NAME} AS event_name").selectExpr(
        "us AS event_timestamp", "event_name", "concat('u', u) AS user_pseudo_id",
        "if(u % 3 = 0, concat('c', u), NULL) AS user_id", "e AS src_event_id",
        f"flatten(array({params})) AS event_params",
        f"""named_struct(
            'category', {_pick("u % 5", "desktop", "mobile", "tablet", "smart tv")},
            'mobile_brand_name', {_pick("e % 3", "Apple", "Samsung")},
            'mobile_model_name', {_pick("e % 3", "m1", "m2")},
            'operating_system', {_pick("u % 4", "Windows", "Android", "iOS")},
            'operating_system_version', {_pick("e % 2", "10", "11")}) AS device""",
        f"""named_struct(
            'country', {_pick("u % 10", "United States", "Canada", "Brazil", "Argentina",
                              "Spain", "France", "Japan", "India", "Kenya")},
            'region', concat('r', u % 3), 'city', {_pick("u % 3", "A", "B")},
            'continent', {_pick("u % 10", "Americas", "Americas", "Americas", "Americas",
                                "Europe", "Europe", "Asia", "Asia", "Africa")}) AS geo""",
        f"""named_struct(
            'name', {_pick("u % 4", "(organic)", "(direct)", "brand")},
            'medium', {_pick("u % 4", "organic", "(none)", "cpc")},
            'source', {_pick("u % 4", "google", "(direct)", "bing")}) AS traffic_source""",
        f"""named_struct(
            'total_item_quantity', if({bought}, k % 4 + 1, NULL),
            'purchase_revenue', if({bought}, v, NULL),
            'purchase_revenue_currency', if({bought}, 'USD', NULL)) AS ecommerce""",
        "date_format(at, 'yyyyMMdd') AS event_date")


def run_log(events: DataFrame) -> DataFrame:
    """One audit row per event, in the shape of ``etl_run_log``."""
    job = _pick("e % 3", "daily_load", "data_quality_checks", "audit_monitoring")
    return _base(events).selectExpr(
        "concat('r', e) AS run_id", "CAST(at AS DATE) AS run_date", f"{job} AS dag_id",
        "concat('t', e % 7) AS task_id",
        "CASE kind WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' "
        "ELSE 'success' END AS status",
        "e % 1000 AS rows_processed",
        "CAST(round(v * 100) AS BIGINT) * 1000000 AS bytes_processed",
        "u AS duration_seconds", "if(kind = 'error', concat('E', k % 5), NULL) AS error_message",
        "at AS run_timestamp")


def query_log(events: DataFrame) -> DataFrame:
    """One query per event: when it ran, what it read and what it was billed."""
    billed = "CAST(round(v * 100) AS BIGINT) * 45000000"
    return _base(events).selectExpr(
        "concat('j', e) AS job_id", "at AS creation_time",
        "if(kind = 'signup', 'INSERT', 'SELECT') AS statement_type",
        f"{billed} * (e % 10 + 1) div 10 AS total_bytes_processed",
        f"{billed} AS total_bytes_billed", "e * 10 AS total_slot_ms",
        "concat('SELECT * FROM stg_events_flat WHERE event_date_partition = ''', "
        "date_format(at, 'yyyy-MM-dd'), '''') AS query")
