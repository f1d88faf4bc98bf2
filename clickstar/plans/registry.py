"""Every registered query: a Spark plan over the warehouse and its DuckDB SQL.

Stage, dimension, fact and mart queries cover all days; alerts, checks and audits
the run date; look-backs count from the day after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar.functions import event_params as ep
from clickstar.functions import keys, rules
from clickstar.operators import dims as D
from clickstar.operators import (facts, journeys, lifetime, marts, merge, metrics, monitor, quality,
                                 rolling, rollup, stage, tables)
from clickstar.plans import oracle as O
from clickstar.plans.warehouse import Warehouse
from clickstar import schemas
from clickstar.schemas import TABLES, Table
from clickstar.sources import calendar, raw
from clickstar.streaming import jobs

Query = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RUN, AS_OF = O.RUN, O.AS_OF
N = "count(*) AS sessions"
CONV = "CAST(sum(conversions) AS BIGINT) AS conversions"
LEADS = "CAST(sum(leads) AS BIGINT) AS leads"
ENGAGED = "CAST(sum(engaged_sessions) AS BIGINT) AS engaged_sessions"
RATE = "R2<sum(conversions) * 100.0 / count(*)>R2 AS conversion_rate"
VALUE = "round(sum(total_conversion_value), 4) AS total_conversion_value"


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to 4 places: sums differ in their last bits by the order of their rows.

    Only here; the operators and the written tables keep full values.
    """
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, 4) for c in doubles}) if doubles else df


def add(name: str, query: Query, sql: str | None = None) -> None:
    """Registers a query. ``R2<x>R2`` in its SQL rounds x to 2 places, halves upwards."""
    assert name not in QUERIES, name
    QUERIES[name] = lambda w: comparable(query(w))
    if sql is not None:
        sql = sql.replace("R2<", "CAST(round(CAST(")
        SQL[name] = O.with_ctes(sql.replace(">R2", " AS DECIMAL(38, 9)), 2) AS DOUBLE)"))


def day(w: Warehouse) -> dt.date:
    return w.params.run_date


def back(w: Warehouse, days: int) -> dt.date:
    return w.params.days_back(days)


def flat_table(w: Warehouse) -> DataFrame:
    return w.table("stg_events_flat")


def sessions_table(w: Warehouse) -> DataFrame:
    return w.table("stg_sessions")


def flat_day(w: Warehouse) -> DataFrame:
    return raw.scan_partition(flat_table(w), "event_date_partition", day(w))


def sessions_day(w: Warehouse) -> DataFrame:
    return raw.scan_partition(sessions_table(w), "session_date", day(w))


def fact_day(w: Warehouse) -> DataFrame:
    return raw.scan_partition(w.table("fact_sessions"), "session_date", day(w))


# --- sources ---------------------------------------------------------------------------

RAW = ["event_date", "event_timestamp", "event_name", "user_pseudo_id", "user_id",
       "src_event_id", "table_suffix"]
RAW_SQL = ("event_date, event_timestamp, event_name, user_pseudo_id, user_id, src_event_id, "
           "table_suffix")
WEEK_AGO = O._day(O.P.run_date - dt.timedelta(days=6))
add("scan_raw", lambda w: raw.scan_raw(w.export, day(w) - dt.timedelta(days=6), day(w))
    .select(*RAW, "device.category", F.size("event_params").alias("params")),
    f"""SELECT {RAW_SQL}, device_category AS category, CAST(2 + (ga_session_id IS NOT NULL)::INT
      + (page_location IS NOT NULL)::INT + (page_referrer IS NOT NULL)::INT
      + (utm_source IS NOT NULL)::INT + (utm_medium IS NOT NULL)::INT
      + (utm_campaign IS NOT NULL)::INT + (utm_term IS NOT NULL)::INT
      + (utm_content IS NOT NULL)::INT + (lead_id IS NOT NULL)::INT
      + (conversion_value IS NOT NULL)::INT AS INTEGER) AS params FROM flat
      WHERE event_date_partition BETWEEN {WEEK_AGO} AND {RUN}""")
add("scan_raw_day", lambda w: raw.scan_raw_day(w.export, day(w)).select(*RAW),
    f"SELECT {RAW_SQL} FROM flat WHERE event_date_partition = {RUN}")
add("scan_partition", lambda w: sessions_day(w).select("session_id", "session_date",
                                                       "events_count", "source", "medium"),
    f"""SELECT session_id, session_date, events_count, source, medium FROM sess
      WHERE session_date = {RUN}""")
add("scan_lookback", lambda w: raw.scan_lookback(
    flat_table(w), "event_date_partition", back(w, 7)).select(
        "event_date_partition", "event_name", "session_id", "src_event_id"),
    f"""SELECT event_date_partition, event_name, session_id, src_event_id FROM flat
      WHERE event_date_partition >= {O.back(7)}""")


def generated_dates(w: Warehouse) -> DataFrame:
    """Every day between the first and last event, with its volume."""
    volumes = monitor.daily_volumes(flat_table(w))
    span = volumes.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    every = span.select(F.explode(F.sequence("a", "b")).alias("date_value"))
    return every.join(volumes, F.col("date_value") == F.col("date"), "left").select(
        "date_value", F.coalesce("events_count", F.lit(0)).alias("events_count"))


add("generate_dates", generated_dates,
    """SELECT date_value, coalesce(events_count, 0) AS events_count
      FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_value
      FROM (SELECT min(date) AS a, max(date) AS b FROM vol)) LEFT JOIN vol ON date = date_value""")
add("literal_rows", lambda w: calendar.holidays(w.spark).join(
    monitor.daily_volumes(flat_table(w)), F.col("holiday_date") == F.col("date"), "left").select(
        "holiday_date", F.coalesce("events_count", F.lit(0)).alias("events_count")),
    f"""SELECT holiday_date, coalesce(events_count, 0) AS events_count
      FROM (SELECT CAST(unnest([{", ".join(f"'{h}'" for h in V.HOLIDAYS)}]) AS DATE)
      AS holiday_date) LEFT JOIN vol ON date = holiday_date""")
add("raw_arrived", lambda w: raw.raw_arrived(w.export, day(w)),
    f"""SELECT {RUN} AS run_date, count(*) AS raw_rows, count(*) > 0 AS arrived FROM flat
      WHERE event_date_partition = {RUN}""")


def changed_shards(w: Warehouse) -> DataFrame:
    """Against an export that lacked one event in 97 of the week before the run date, and all later days."""
    lacked = w.export.where((F.col("event_date") <= w.params.shard) & ~(
        (F.col("src_event_id") % 97 == 0)
        & (F.col("event_date") > (day(w) - dt.timedelta(days=7)).strftime("%Y%m%d"))))
    return raw.changed_shards(raw.shard_fingerprints(w.export), raw.shard_fingerprints(lacked))


add("changed_shards", changed_shards,
    f"""SELECT event_date, event_date_partition > {RUN} AS is_new FROM flat
      WHERE event_date_partition > {RUN} OR (event_date_partition > {RUN} - 7
      AND src_event_id % 97 = 0) GROUP BY 1, 2""")
add("inspect_shards", lambda w: raw.list_shards(w.export),
    """SELECT table_suffix, count(*) AS raw_rows FROM flat GROUP BY 1
      ORDER BY 1 DESC LIMIT 10""")
add("sample_shard", lambda w: raw.sample_shard(w.export, day(w)).select(*RAW),
    f"""SELECT {RAW_SQL} FROM flat WHERE event_date_partition = {RUN}
      ORDER BY event_timestamp, src_event_id LIMIT 10""")

# --- sinks and loads ---------------------------------------------------------------------

SHORT = ["session_id", "session_date", "user_pseudo_id", "user_id", "events_count",
         "total_conversion_value", "landing_page"]
SHORT_SQL = ", ".join(SHORT)


def written_replace(w: Warehouse) -> DataFrame:
    path = w.scratch("write_replace")
    tables.write_replace(sessions_table(w).select(*SHORT), path)
    return w.spark.read.parquet(path)


def written_partitioned(w: Warehouse) -> DataFrame:
    """All days written, then the run date written again: no row doubles."""
    path = w.scratch("write_partitioned")
    layout = ("session_date", ("session_id", "landing_page"))
    tables.write_partitioned(sessions_table(w).select(*SHORT), path, *layout)
    tables.write_partitioned(sessions_day(w).select(*SHORT), path, *layout)
    return w.spark.read.parquet(path)


add("write_replace", written_replace, f"SELECT {SHORT_SQL} FROM sess")
add("write_partitioned", written_partitioned, f"SELECT {SHORT_SQL} FROM sess")


def ensured(w: Warehouse) -> DataFrame:
    """An empty declared table, then the facts appended to it."""
    path, table = w.scratch("ensure_table"), TABLES["fact_sessions"]
    tables.ensure_table(w.spark, path, table.schema, table.partition)
    rows = w.table("fact_sessions").withColumn("_etl_timestamp", F.lit(None).cast("timestamp"))
    tables.write_partitioned(rows.select(table.schema.names), path, table.partition,
                             table.cluster)
    return tables.read_table(w.spark, path, table.schema).drop("_etl_timestamp")


add("ensure_table", ensured, "SELECT * FROM g_sessions")

# A rerun of the run date and first load of later days: matched rows change in the update
# columns only, later days are inserted.
CHANGED = "changed"


def corrected(rows: DataFrame, update: dict[str, object]) -> DataFrame:
    """The source of a merge: changed values, and a changed key that must not stick."""
    return rows.withColumns({**update, "device_key": F.lit(CHANGED)})


def merged(w: Warehouse, name: str, update: dict) -> DataFrame:
    table, rows = TABLES[name], w.table(name)
    date = F.col(table.partition)
    run = F.lit(day(w))
    return merge.merge_rows(
        rows.where(date <= run), corrected(rows.where(date >= run), update),
        list(table.merge_keys), [c for c in table.update_columns if c in rows.columns])


def merge_sql(cte: str, date: str, update: dict[str, str]) -> str:
    new = ", ".join(f"if({date} >= {RUN}, {expr}, {c}) AS {c}" for c, expr in update.items())
    return f"""SELECT * REPLACE ({new},
      if({date} > {RUN}, '{CHANGED}', device_key) AS device_key) FROM {cte}"""


add("merge_upsert", lambda w: merged(w, "fact_sessions", {
    "events_count": F.col("events_count") * 2, "landing_page": F.lit(CHANGED)}),
    merge_sql("g_sessions", "session_date", {"events_count": "events_count * 2",
                                             "landing_page": f"'{CHANGED}'"}))
add("merge_upsert_events", lambda w: merged(w, "fact_events", {
    "page_title": F.lit(CHANGED), "purchase_revenue": F.col("purchase_revenue") * 2}),
    merge_sql("g_events", "event_date", {"page_title": f"'{CHANGED}'",
                                         "purchase_revenue": "purchase_revenue * 2"}))
add("merge_upsert_conversions", lambda w: merged(w, "fact_conversions", {
    "lead_id": F.lit(CHANGED), "conversion_number": F.col("conversion_number") + 100}),
    merge_sql("g_conversions", "conversion_date", {
        "lead_id": f"'{CHANGED}'", "conversion_number": "conversion_number + 100"}))


def merged_all_columns(w: Warehouse) -> DataFrame:
    rows = stage.sessions_conformed(flat_table(w)).select(*SHORT)
    date, run = F.col("session_date"), F.lit(day(w))
    source = rows.where(date >= run).withColumn("landing_page", F.lit(CHANGED))
    return merge.incremental_merge(rows.where(date <= run), source, "session_id")


add("incremental_merge", merged_all_columns,
    f"""SELECT {SHORT_SQL} FROM (SELECT * REPLACE (if(session_date >= {RUN}, '{CHANGED}',
      landing_page) AS landing_page) FROM sess_real)""")


def merge_loaded(w: Warehouse) -> DataFrame:
    """Days merged into a written table one after the other, the last one twice."""
    table, path = TABLES["fact_sessions"], w.scratch("merge_job")
    rows = w.table("fact_sessions").withColumn("_etl_timestamp", F.lit(None).cast("timestamp"))
    rows = rows.select(table.schema.names)
    date, run = F.col("session_date"), F.lit(day(w))
    for part in (rows.where(date < run), rows.where(date >= run), rows.where(date >= run)):
        merge.merge_table(w.spark, path, part, table)
    return tables.read_table(w.spark, path, table.schema).drop("_etl_timestamp")


add("merge_job", merge_loaded, "SELECT * FROM g_sessions")
add("insert_if_absent", lambda w: D.insert_if_absent(
    w.dim("dim_channel"), D.unknown_member(w.dim("dim_channel"), D.CHANNEL,
                                           D.CHANNEL.key_parts), "channel_key"),
    "SELECT * FROM c_channel")


def appended_runs(w: Warehouse) -> DataFrame:
    """The run log appended in two halves by date."""
    path = w.fresh("append_run_log")
    date, run = F.col("run_date"), F.lit(day(w))
    tables.ensure_table(w.spark, path, schemas.ETL_RUN_LOG, "run_date")
    for half in (w.run_log.where(date < run), w.run_log.where(date >= run)):
        tables.append_rows(tables.laid_out(half, "run_date", ("dag_id",)), path, "run_date")
    return tables.read_table(w.spark, path, schemas.ETL_RUN_LOG)


def appended_checks(w: Warehouse) -> DataFrame:
    """The quality log of all days, appended in two halves by date."""
    path, log = w.fresh("append_dq_log"), w.quality_log()
    date, run = F.col("check_date"), F.lit(day(w))
    for half in (log.where(date < run), log.where(date >= run)):
        tables.append_rows(tables.laid_out(half, "check_date", ("layer",)), path, "check_date")
    return w.spark.read.parquet(path)


add("append_run_log", appended_runs, "SELECT * FROM rlog")
add("append_dq_log", appended_checks, "SELECT * FROM dq_history")


def retained(w: Warehouse) -> DataFrame:
    """Sessions with the days before the run date dropped."""
    path = w.scratch("delete_before")
    tables.write_partitioned(sessions_table(w).select(*SHORT), path, "session_date",
                             ("session_id",))
    tables.delete_before(w.spark, path, "session_date", day(w))
    return w.spark.read.parquet(path)


add("delete_before", retained, f"SELECT {SHORT_SQL} FROM sess WHERE session_date >= {RUN}")


def reclustered(w: Warehouse) -> DataFrame:
    path = w.scratch("recluster")
    if not tables.exists(w.spark, path):
        tables.write_partitioned(sessions_table(w).select(*SHORT), path, "session_date",
                                 ("session_id",))
        tables.recluster(w.spark, path, "session_date", ("landing_page", "session_id"))
    return w.spark.read.parquet(path)


def migrated(w: Warehouse) -> DataFrame:
    path = w.scratch("backup_and_migrate")
    if not tables.exists(w.spark, path):
        tables.write_partitioned(sessions_table(w).select(*SHORT), path, "session_date")
        tables.backup_and_migrate(w.spark, path, "session_date", ("user_pseudo_id",), 2)
    return w.spark.read.parquet(f"{path}_v2")


add("recluster", reclustered, f"SELECT {SHORT_SQL} FROM sess")
add("backup_and_migrate", migrated, f"SELECT {SHORT_SQL} FROM sess")


def viewed(w: Warehouse) -> DataFrame:
    tables.create_view(w.mart_sessions(), "clickstar_mart_sessions")
    return w.spark.sql("""SELECT channel_group, count(*) AS sessions,
        sum(conversions) AS conversions FROM clickstar_mart_sessions GROUP BY channel_group""")


add("create_view", viewed, f"SELECT channel_group, {N}, {CONV} FROM mart GROUP BY 1")

# --- flattening --------------------------------------------------------------------------

ID = "src_event_id"
add("event_param", lambda w: w.raw.select(
    ID, ep.event_param("page_location", "string_value").alias("page_location"),
    ep.event_param("ga_session_id", "int_value").alias("ga_session_id"),
    ep.event_param("session_engaged", "int_value").alias("session_engaged"),
    ep.event_param("lead_id", "string_value").alias("lead_id")),
    f"SELECT {ID}, page_location, ga_session_id, session_engaged, lead_id FROM flat")
add("event_param_typed", lambda w: w.raw.select(
    ID, ep.event_param_typed("utm_source", "string").alias("utm_source"),
    ep.event_param_typed("ga_session_id", "int").alias("ga_session_id"),
    ep.event_param_typed("session_engaged", "double").alias("session_engaged"),
    ep.event_param_typed("page_title", "other").alias("page_title")),
    f"""SELECT {ID}, utm_source, CAST(ga_session_id AS VARCHAR) AS ga_session_id,
      CAST(NULL AS VARCHAR) AS session_engaged, page_title FROM flat""")
add("stg_events_flat", lambda w: w.flat, "SELECT * FROM flat")
add("stg_events_flat_lite", lambda w: stage.flatten_lite(w.raw),
    f"SELECT {', '.join(stage.FLAT_LITE_COLUMNS)} FROM flat")
add("struct_fields", lambda w: w.raw.select(
    ID, "device.category", "device.operating_system", "geo.country", "traffic_source.medium",
    "ecommerce.purchase_revenue"),
    f"""SELECT {ID}, device_category AS category, device_os AS operating_system, country,
      traffic_source_medium AS medium, purchase_revenue FROM flat""")
add("parse_event_date", lambda w: w.raw.select(
    ID, "event_date", stage.parse_event_date(F.col("event_date")).alias("event_date_partition"),
    stage.parse_event_date(F.col("event_date")).cast("timestamp").alias("event_timestamp_date")),
    f"SELECT {ID}, event_date, event_date_partition, event_timestamp_date FROM flat")
add("session_key", lambda w: w.flat.select(ID, "session_id"),
    f"SELECT {ID}, session_id FROM flat")
add("page_domain", lambda w: w.flat.groupBy("page_domain").agg(
    F.count(F.lit(1)).alias("events"), F.count("page_location").alias("located")),
    "SELECT page_domain, count(*) AS events, count(page_location) AS located FROM flat GROUP BY 1")
add("is_conversion_event", lambda w: w.flat.select(ID, "event_name", "is_conversion_event"),
    f"SELECT {ID}, event_name, is_conversion_event FROM flat")
add("is_lead_event", lambda w: w.flat.select(ID, "event_name", "is_lead_event"),
    f"SELECT {ID}, event_name, is_lead_event FROM flat")
add("filter_conversions", lambda w: facts.conversions(flat_day(w)).select(
    ID, "event_name", "session_id", "conversion_value"),
    f"""SELECT {ID}, event_name, session_id, conversion_value FROM conv
      WHERE event_date_partition = {RUN}""")
add("filter_any_utm", lambda w: w.flat.where(D.any_known(*D.CAMPAIGN.needed)).select(
    ID, *D.CAMPAIGN.needed),
    f"""SELECT {ID}, utm_source, utm_medium, utm_campaign FROM flat
      WHERE coalesce(utm_source, utm_medium, utm_campaign) IS NOT NULL""")
add("select_star_plus", lambda w: w.flat.select(
    "*", rules.event_category(F.col("event_name")).alias("event_category")),
    f"SELECT *, {O._table_case('event_name', V.EVENT_CATEGORIES)} AS event_category FROM flat")
add("region_filter", lambda w: marts.region_filter(w.mart_sessions(), "r1").select(
    "session_id", "user_pseudo_id", "session_date", "region", "conversions"),
    """SELECT session_id, user_pseudo_id, session_date, region, conversions FROM mart
      WHERE region = 'r1'""")
add("lookup_examples", lambda w: flat_table(w).where(
    F.col("event_date_partition").between(F.lit(back(w, 7)), F.lit(day(w)))
    & (F.col("event_name") == "page_view") & (F.col("user_pseudo_id") == "u7")).select(
        ID, "event_date_partition", "event_name", "user_pseudo_id", "page_location"),
    f"""SELECT {ID}, event_date_partition, event_name, user_pseudo_id, page_location FROM flat
      WHERE event_date_partition BETWEEN {O.back(7)} AND {RUN} AND event_name = 'page_view'
      AND user_pseudo_id = 'u7'""")

# --- sessions and users --------------------------------------------------------------------

GRAIN = ", ".join(stage.SESSION_GRAIN)
add("stg_sessions", lambda w: stage.sessions(w.flat),
    f"SELECT {', '.join(O.SESSION_COLUMNS)} FROM sess")
add("stg_sessions_day", lambda w: stage.sessions(flat_day(w)),
    f"SELECT {', '.join(O.SESSION_COLUMNS)} FROM sess WHERE session_date = {RUN}")
add("stg_sessions_lite", lambda w: stage.sessions_lite(w.flat),
    f"SELECT {', '.join(stage.SESSION_LITE_COLUMNS)} FROM sess")
add("session_bounds", lambda w: stage.session_bounds(w.flat, "event"),
    """SELECT session_id, user_pseudo_id, user_id, ga_session_id, event_date_partition,
      make_timestamp(min(event_timestamp)) AS session_start_timestamp,
      make_timestamp(max(event_timestamp)) AS session_end_timestamp,
      (max(event_timestamp) - min(event_timestamp)) // 1000000 AS session_duration_seconds
      FROM flat GROUP BY ALL""")
for _name, _columns in {
    "session_counts": ["events_count", "unique_events_count", "pageviews", "scrolls"],
    "session_flags": ["has_conversion", "has_lead", "conversion_events_count",
                      "lead_events_count"],
    "session_values": ["total_conversion_value", "max_purchase_revenue",
                       "total_purchase_revenue"],
    "session_first_last": ["landing_page", "exit_page", "device_category", "device_os",
                           "country", "region", "city", "campaign", "term", "content"],
    "traffic_source_coalesce": ["source", "medium"],
}.items():
    add(_name, lambda w, c=_columns: stage.sessions(w.flat).select(*stage.SESSION_GRAIN, *c),
        f"SELECT {GRAIN}, {', '.join(_columns)} FROM sess")
add("stg_users", lambda w: stage.users(
    raw.scan_lookback(sessions_table(w), "session_date", back(w, 90))), "SELECT * FROM usr")
add("stg_users_lite", lambda w: stage.users_lite(
    raw.scan_lookback(sessions_table(w), "session_date", back(w, 90))),
    """SELECT * EXCLUDE (total_user_conversion_value, total_user_purchase_revenue,
      total_engaged_sessions, primary_source, primary_medium) FROM usr""")


def days_of(w: Warehouse, name: str, column: str) -> list[dt.date]:
    return tables.partition_days(w.spark, w.path(name), column)


def users_rolled(w: Warehouse) -> DataFrame:
    """Parts of all days but two at once, then two daily loads."""
    path, days = w.fresh("user_parts"), days_of(w, "stg_sessions", "session_date")
    for load in (days[:-2], days[-2:-1], days[-1:]):
        if load:
            rolling.build(w.spark, path, sessions_table(w), load)
    return rolling.users_rolled(w.spark, path, back(w, 90), days[-1])


add("stg_users_rolled", users_rolled, "SELECT * FROM usr")
add("sessions_conformed", lambda w: stage.sessions_conformed(w.flat),
    f"SELECT {', '.join(O.SESSION_COLUMNS)} FROM sess_real")
add("gap_sessions", lambda w: stage.gap_sessions(w.flat),
    """SELECT user_pseudo_id, make_timestamp(min(t)) AS first_event_at,
      make_timestamp(max(t)) AS last_event_at, count(*) AS events_count
      FROM (SELECT user_pseudo_id, t, sum(new) OVER (PARTITION BY user_pseudo_id ORDER BY t, id
      ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_pseudo_id, event_timestamp AS t,
      src_event_id AS id, if(event_timestamp - lag(event_timestamp) OVER (PARTITION BY
      user_pseudo_id ORDER BY event_timestamp, src_event_id) < 1800000000, 0, 1) AS new
      FROM flat)) GROUP BY user_pseudo_id, s""")

# --- dimensions --------------------------------------------------------------------------


def calendar_with_volume(w: Warehouse) -> DataFrame:
    """The calendar, each day with its events."""
    return D.dim_date(w.spark).join(
        monitor.daily_volumes(w.flat), F.col("date_key") == F.col("date"), "left").drop(
        "date").withColumn("events_count", F.coalesce("events_count", F.lit(0)))


add("dim_date", calendar_with_volume,
    """SELECT d_date.*, coalesce(events_count, 0) AS events_count FROM d_date
      LEFT JOIN vol ON date = date_key""")
for _dim, _cte in ((D.DEVICE, "device"), (D.GEO, "geo"), (D.CAMPAIGN, "campaign"),
                   (D.EVENT_TYPE, "event")):
    add(_dim.name, lambda w, d=_dim: D.members(w.flat, d), f"SELECT * FROM d_{_cte}")
    add(f"{_dim.name}_conformed", lambda w, d=_dim: D.conformed(w.flat, d),
        f"SELECT * FROM c_{_cte}")
add("dim_channel", lambda w: D.members(sessions_table(w), D.CHANNEL), "SELECT * FROM d_channel")
add("dim_channel_conformed", lambda w: D.conformed(sessions_table(w), D.CHANNEL),
    "SELECT * FROM c_channel")


def extended(w: Warehouse, dim: D.Dimension) -> DataFrame:
    """Built from the days before the run date, then extended by the later ones."""
    date, run = F.col("event_date_partition"), F.lit(day(w))
    rows = flat_table(w)
    return D.extend(D.conformed(rows.where(date < run), dim), rows.where(date >= run), dim)


add("dim_device_extended", lambda w: extended(w, D.DEVICE), "SELECT * FROM c_device")
add("dim_campaign_extended", lambda w: extended(w, D.CAMPAIGN), "SELECT * FROM c_campaign")
add("channel_group", lambda w: sessions_table(w).groupBy(
    rules.channel_group(F.col("source"), F.col("medium")).alias("channel_group")).agg(
        F.count(F.lit(1)).alias("sessions")),
    "SELECT channel_group, count(*) AS sessions FROM (SELECT "
    f"{O._channel_case()} AS channel_group FROM sess) GROUP BY 1")
add("channel_type", lambda w: sessions_table(w).groupBy(
    rules.channel_type(F.col("medium")).alias("channel_type")).agg(
        F.count(F.lit(1)).alias("sessions")),
    "SELECT channel_type, count(*) AS sessions FROM (SELECT "
    f"{O._table_case('medium', V.CHANNEL_TYPES)} AS channel_type FROM sess) GROUP BY 1")
add("surrogate_key", lambda w: w.flat.select(
    ID, keys.surrogate_key("device_category", "device_os", "device_mobile_brand")
    .alias("device_key"), F.sha2("event_name", 256).alias("event_type_key")),
    f"""SELECT {ID}, sha256(concat_ws('|', coalesce(device_category, 'unknown'),
      coalesce(device_os, 'unknown'), coalesce(device_mobile_brand, 'unknown'))) AS device_key,
      sha256(event_name) AS event_type_key FROM flat""")

# --- facts and marts -----------------------------------------------------------------------

add("fact_sessions", lambda w: w.fact_sessions(), "SELECT * FROM f_sessions")
add("fact_events", lambda w: w.fact_events(), "SELECT * FROM f_events")
add("fact_conversions", lambda w: w.fact_conversions(), "SELECT * FROM f_conversions")
add("fact_conversions_day", lambda w: facts.fact_conversions(
    flat_day(w), w.dims(events=True)),
    f"SELECT * FROM f_conversions WHERE conversion_date = {RUN}")
add("fact_sessions_conformed", lambda w: facts.fact_sessions(
    w.table("stg_sessions_real"), w.dims(True), True), "SELECT * FROM g_sessions")
add("fact_events_conformed", lambda w: facts.fact_events(
    flat_table(w), w.dims(True, True), True), "SELECT * FROM g_events")
add("fact_conversions_conformed", lambda w: facts.fact_conversions(
    flat_table(w), w.dims(True, True), True), "SELECT * FROM g_conversions")
add("mart_sessions", lambda w: w.mart_sessions(False), "SELECT * FROM m_sessions")
add("mart_conversions", lambda w: w.mart_conversions(False), "SELECT * FROM m_conversions")
add("mart_sessions_conformed", lambda w: w.mart_sessions(), "SELECT * FROM mart")
add("mart_conversions_conformed", lambda w: w.mart_conversions(), "SELECT * FROM mart_conv")

# --- joins and windows ---------------------------------------------------------------------

CHANGES_SQL = """SELECT 'volume_drop' AS alert_type, a.date AS check_date,
      if(coalesce((a.events_count - b.events_count) / b.events_count < -0.2, false),
         'FAIL', 'PASS') AS status, a.events_count, b.events_count AS previous_count,
      R2<(a.events_count - b.events_count) / b.events_count * 100>R2 AS pct_change
      FROM vol AS a LEFT JOIN vol AS b ON a.date = b.date + 1"""
add("self_join_prev_day", lambda w: monitor.volume_changes(flat_table(w)), CHANGES_SQL)
for _dim, _column in quality.REFERENCES.items():
    _cte = _dim.replace("dim_", "")
    add(f"orphans_{_cte}", lambda w, d=_dim, c=_column: quality.orphans(
        w.table("fact_sessions"), w.table("dim_date") if d == "dim_date" else w.dim(d), c).groupBy(
            "session_date").agg(F.count(F.lit(1)).alias("orphan_sessions")),
        f"""SELECT session_date, count(*) AS orphan_sessions FROM g_sessions AS f
          WHERE NOT EXISTS (FROM d_{_cte} AS d WHERE d.{_column} = f.{_column}) GROUP BY 1""")
add("exists_correlated", lambda w: w.run_log.where(F.col("status") != "failed").select(
    "run_date", "dag_id", "task_id").distinct().join(
        w.run_log.where(F.col("status") == "failed").select("run_date", "dag_id", "task_id")
        .distinct(), ["run_date", "dag_id", "task_id"], "left_semi"),
    """SELECT DISTINCT run_date, dag_id, task_id FROM rlog AS a WHERE status <> 'failed'
      AND EXISTS (FROM rlog AS b WHERE b.status = 'failed' AND b.run_date = a.run_date
      AND b.dag_id = a.dag_id AND b.task_id = a.task_id)""")
add("not_exists", lambda w: w.dim("dim_campaign").select("utm_source", "utm_medium").distinct()
    .join(w.dim("dim_channel").select(F.col("source").alias("utm_source"),
                                      F.col("medium").alias("utm_medium")),
          ["utm_source", "utm_medium"], "left_anti"),
    """SELECT DISTINCT utm_source, utm_medium FROM d_campaign AS c WHERE NOT EXISTS
      (FROM d_channel AS h WHERE h.source = c.utm_source AND h.medium = c.utm_medium)""")
add("in_subquery", lambda w: flat_table(w).groupBy("event_date_partition", F.col("event_date_partition")
    .isin([F.lit(h).cast("date") for h in V.HOLIDAYS]).alias("is_holiday")).agg(
        F.count(F.lit(1)).alias("events")),
    f"""SELECT event_date_partition, strftime(event_date_partition, '%Y-%m-%d')
      IN {O._in(V.HOLIDAYS)} AS is_holiday, count(*) AS events FROM flat GROUP BY 1, 2""")
add("channel_join_by_key", lambda w: w.fact_sessions(True).join(
    w.dim("dim_channel", True), "channel_key").groupBy("source", "medium", "channel_group").agg(
        F.count(F.lit(1)).alias("sessions")),
    """SELECT source, medium, channel_group, count(*) AS sessions FROM g_sessions
      JOIN c_channel USING (channel_key) GROUP BY ALL""")
add("channel_join_by_columns", lambda w: sessions_table(w).join(
    w.dim("dim_channel"), ["source", "medium"]).groupBy(
        "source", "medium", "channel_group").agg(F.count(F.lit(1)).alias("sessions")),
    """SELECT source, medium, channel_group, count(*) AS sessions FROM sess
      JOIN d_channel USING (source, medium) GROUP BY ALL""")
add("conversion_number", lambda w: facts.numbered_conversions(flat_table(w)).select(
    ID, "event_date_partition", "user_pseudo_id", "event_name", "conversion_number"),
    f"""SELECT {ID}, event_date_partition, user_pseudo_id, event_name, conversion_number
      FROM conv""")
add("is_first_conversion", lambda w: facts.numbered_conversions(flat_table(w)).where(
    "is_first_conversion").select(ID, "event_date_partition", "user_pseudo_id",
                                  "is_first_conversion"),
    f"""SELECT {ID}, event_date_partition, user_pseudo_id, true AS is_first_conversion FROM conv
      WHERE conversion_number = 1""")
add("conversion_number_lifetime", lambda w: facts.numbered_conversions(
    flat_table(w), lifetime=True).select(ID, "user_pseudo_id", "event_name",
                                         "conversion_number", "is_first_conversion"),
    f"""SELECT {ID}, user_pseudo_id, event_name, lifetime_number AS conversion_number,
      lifetime_number = 1 AS is_first_conversion FROM conv""")



def numbers_carried(w: Warehouse) -> DataFrame:
    """History at once, then the last two days from the counters, one of them twice."""
    root, days = w.fresh("lifetime"), days_of(w, "stg_events_flat", "event_date_partition")
    paths = f"{root}/counters", f"{root}/numbers"
    if days[:-2]:
        lifetime.backfill(w.spark, *paths, flat_table(w), days[:-2][-1])
    for at in [*days[-2:], *days[-1:]]:
        lifetime.load_day(w.spark, *paths, flat_table(w), at)
    return w.spark.read.parquet(paths[1]).select(ID, "user_pseudo_id", "event_name",
                                                 "conversion_number", "is_first_conversion")


add("conversion_number_carried", numbers_carried)
SQL["conversion_number_carried"] = SQL["conversion_number_lifetime"]

# --- journeys --------------------------------------------------------------------------------


def funnel_sql(steps: journeys.Steps, minutes: int) -> str:
    """From each event of step 1 the earliest event of every next step, inside the window."""
    number = " ".join(f"WHEN event_name IN {O._in(list(names))} THEN {j}"
                      for j, (_, names) in enumerate(steps, 1))
    chains = ["c1 AS (SELECT u, t AS start, id AS start_id, {'t': t, 'id': id} AS at FROM s WHERE step = 1)"]
    for j in range(2, len(steps) + 1):
        chains.append(f"""c{j} AS (SELECT c.u, start, start_id, min({{'t': s.t, 'id': s.id}}) AS at
          FROM c{j - 1} c JOIN s ON s.u = c.u AND s.step = {j} AND (s.t, s.id) > (c.at.t, c.at.id)
          AND s.t - start <= {minutes * journeys.MINUTE} GROUP BY ALL)""")
    reached = " UNION ALL ".join(
        f"SELECT {j} AS step, '{name}' AS step_name, u FROM c{j}" for j, (name, _) in enumerate(steps, 1))
    names = " UNION ALL ".join(
        f"SELECT {j} AS step, '{name}' AS step_name" for j, (name, _) in enumerate(steps, 1))
    return f"""SELECT channel_group, CAST(step AS BIGINT) AS step, step_name, users,
      R2<users * 100.0 / nullif(coalesce(lag(users) OVER w, users), 0)>R2 AS step_rate,
      R2<users * 100.0 / nullif(first(users) OVER w, 0)>R2 AS entry_rate FROM (
      WITH s AS (SELECT user_pseudo_id AS u, event_timestamp AS t, src_event_id AS id,
        CASE {number} END AS step, {O._channel_case()} AS channel_group FROM (SELECT * EXCLUDE (
        step), {O._u("utm_source", "traffic_source_source")} AS source,
        {O._u("utm_medium", "traffic_source_medium")} AS medium FROM (SELECT *, 0 AS step FROM flat))),
      {", ".join(chains)},
      entry AS (SELECT u, first(channel_group ORDER BY t, id) AS channel_group FROM s
        WHERE step = 1 GROUP BY u)
      SELECT channel_group, n.step, n.step_name, count(DISTINCT r.u) AS users
      FROM entry CROSS JOIN ({names}) n LEFT JOIN ({reached}) r
        ON r.u = entry.u AND r.step = n.step GROUP BY ALL)
      WINDOW w AS (PARTITION BY channel_group ORDER BY step)"""


SHORT_FUNNEL = (("view", (V.PAGE_VIEW_EVENT,)), ("lead", tuple(V.LEAD_EVENTS)), ("purchase", ("purchase",)))
add("event_funnel", lambda w: journeys.event_funnel(flat_table(w)),
    funnel_sql(journeys.FUNNEL, 24 * 60))
add("event_funnel_month", lambda w: journeys.event_funnel(flat_table(w), SHORT_FUNNEL, 30 * 24 * 60),
    funnel_sql(SHORT_FUNNEL, 30 * 24 * 60))


def grams_sql(n: int) -> str:
    order = "OVER (PARTITION BY session_id ORDER BY event_timestamp, src_event_id)"
    leads = ", ".join(f"lead(page_location, {i}) {order} AS p{i}" for i in range(1, n))
    return f"""(SELECT page_location AS p0, {leads} FROM flat
      WHERE session_id IS NOT NULL AND page_location IS NOT NULL)"""


add("page_transitions", lambda w: journeys.page_transitions(flat_table(w)),
    f"""SELECT from_page, to_page, transitions,
      R2<transitions * 100.0 / sum(transitions) OVER (PARTITION BY from_page)>R2 AS share_of_from
      FROM (SELECT p0 AS from_page, p1 AS to_page, count(*) AS transitions FROM {grams_sql(2)}
      WHERE p1 IS NOT NULL GROUP BY ALL)""")
add("top_paths", lambda w: journeys.top_paths(flat_table(w)),
    f"""SELECT p0 || ' > ' || p1 || ' > ' || p2 AS path, count(*) AS occurrences FROM {grams_sql(3)}
      WHERE p2 IS NOT NULL GROUP BY p0, p1, p2 ORDER BY occurrences DESC, p0, p1, p2 LIMIT 20""")
add("cohort_retention", lambda w: journeys.cohort_retention(journeys.user_weeks(sessions_table(w))),
    """SELECT CAST(first AS DATE) AS cohort_week, date_diff('day', first, week) // 7 AS weeks_since,
      count(*) AS active_users, max(count(*)) FILTER (first = week) OVER (PARTITION BY first)
      AS cohort_users, R2<count(*) * 100.0 / max(count(*)) FILTER (first = week) OVER (
      PARTITION BY first)>R2 AS retention
      FROM (SELECT DISTINCT user_pseudo_id, date_trunc('week', session_date) AS week,
        date_trunc('week', min(session_date) OVER (PARTITION BY user_pseudo_id)) AS first FROM sess)
      GROUP BY first, week""")

# --- sorts and top-k -----------------------------------------------------------------------

add("order_desc", lambda w: monitor.daily_volumes(flat_table(w)).orderBy(F.desc("date")),
    "SELECT date, events_count FROM vol ORDER BY date DESC")
add("top_k", lambda w: w.query_log.orderBy(F.desc("total_bytes_billed"), "job_id").limit(20)
    .select("job_id", "total_bytes_billed"),
    """SELECT job_id, total_bytes_billed FROM qlog
      ORDER BY total_bytes_billed DESC, job_id LIMIT 20""")
add("latest_runs", lambda w: monitor.latest_runs(w.run_log),
    "SELECT * FROM rlog ORDER BY run_timestamp DESC, run_id LIMIT 10")
add("distinct", lambda w: flat_table(w).select("country", "region", "city").distinct(),
    "SELECT DISTINCT country, region, city FROM flat")
add("union_all", lambda w: flat_table(w).select("utm_source").distinct().unionByName(
    flat_table(w).select(F.col("traffic_source_source").alias("utm_source")).distinct()),
    """SELECT DISTINCT utm_source FROM flat
      UNION ALL SELECT DISTINCT traffic_source_source FROM flat""")

# --- dashboard metrics -----------------------------------------------------------------------


def month(w: Warehouse) -> DataFrame:
    return metrics.since(w.mart_sessions(), back(w, 30))


MONTH = f"mart WHERE session_date >= {O.back(30)}"
KPIS = f"""{N}, {CONV}, {RATE},
      round(avg(session_duration_seconds) / 60, 4) AS avg_duration_min, {LEADS}, {ENGAGED}"""
add("kpi_overview", lambda w: metrics.kpi_overview(w.mart_sessions()),
    f"SELECT {KPIS} FROM mart")
add("channel_rates", lambda w: metrics.rates(w.mart_sessions(), "channel_group"),
    f"""SELECT channel_group, {RATE}, R2<sum(leads) * 100.0 / count(*)>R2 AS lead_rate,
      R2<sum(engaged_sessions) * 100.0 / count(*)>R2 AS engaged_rate,
      round(round(sum(total_conversion_value), 4) / count(*), 4) AS revenue_per_session,
      R2<100 - sum(engaged_sessions) * 100.0 / count(*)>R2 AS bounce_rate,
      round(avg(session_duration_seconds) / 60, 4) AS avg_duration_min FROM mart GROUP BY 1""")
add("sessions_by_date", lambda w: metrics.sessions_by_date(month(w)),
    f"SELECT session_date, {N}, {CONV} FROM {MONTH} GROUP BY 1")
add("sessions_by_channel", lambda w: metrics.sessions_by_channel(month(w)),
    f"SELECT channel_group, {N}, {CONV}, {RATE} FROM {MONTH} GROUP BY 1")
add("sessions_by_device", lambda w: metrics.sessions_by_device(w.mart_sessions()),
    f"SELECT device_category, {N}, {CONV}, {RATE} FROM mart GROUP BY 1")
_MOBILE = " ".join(f"""count(*) FILTER (device_category = '{k}') AS {k}_sessions,
      R2<sum(conversions) FILTER (device_category = '{k}') * 100.0
        / nullif(count(*) FILTER (device_category = '{k}'), 0)>R2 AS {k}_conversion_rate,"""
                   for k in ("mobile", "desktop")).rstrip(",")
add("mobile_vs_desktop", lambda w: metrics.mobile_vs_desktop(w.mart_sessions()),
    f"SELECT {_MOBILE} FROM mart")
add("top_countries", lambda w: metrics.top_countries(w.mart_sessions()),
    f"""SELECT country, {N}, {CONV}, {RATE} FROM mart GROUP BY 1
      ORDER BY sessions DESC, country LIMIT 10""")
add("country_kpis", lambda w: metrics.country_kpis(w.mart_sessions()),
    """SELECT count(*) AS countries, first(country ORDER BY n DESC, country) AS top_country,
      max(n) AS top_country_sessions FROM (SELECT country, count(*) AS n FROM mart
      WHERE country IS NOT NULL GROUP BY 1)""")
add("channel_date_heatmap", lambda w: metrics.channel_date_heatmap(w.mart_sessions()),
    f"SELECT channel_group, session_date, {N}, {CONV} FROM mart GROUP BY 1, 2")
add("channel_comparison", lambda w: metrics.channel_comparison(w.mart_sessions()),
    f"SELECT channel_group, {N}, {CONV}, {LEADS} FROM mart GROUP BY 1")
add("channel_funnel", lambda w: metrics.channel_funnel(w.mart_sessions()),
    """SELECT channel_group, CAST(1 AS BIGINT) AS step, 'sessions' AS step_name,
      sessions AS value, 100.0::DOUBLE AS step_rate FROM x UNION ALL SELECT channel_group, 2,
      'engaged_sessions', engaged_sessions, R2<engaged_sessions * 100.0 / sessions>R2 FROM x
      UNION ALL SELECT channel_group, 3, 'conversions', conversions,
      R2<conversions * 100.0 / nullif(engaged_sessions, 0)>R2 FROM x""".replace(
        "FROM x", f"FROM (SELECT channel_group, {N}, {ENGAGED}, {CONV} FROM mart GROUP BY 1)"))
add("campaign_performance", lambda w: metrics.campaign_performance(w.mart_sessions()),
    f"""SELECT utm_campaign, utm_source, utm_medium, {N}, {CONV}, {RATE}, {VALUE}
      FROM mart GROUP BY 1, 2, 3""")
add("active_campaigns", lambda w: metrics.active_campaigns(w.mart_sessions(), V.UNKNOWN),
    """SELECT count(DISTINCT utm_campaign) AS active_campaigns FROM mart
      WHERE utm_campaign <> 'unknown'""")
add("best_campaign", lambda w: metrics.best_campaign(w.mart_sessions(), V.UNKNOWN),
    f"""SELECT utm_campaign, {N}, {CONV} FROM mart WHERE utm_campaign <> 'unknown' GROUP BY 1
      ORDER BY conversions DESC, utm_campaign LIMIT 1""")
add("top_landing_pages", lambda w: metrics.top_landing_pages(w.mart_sessions()),
    f"""SELECT landing_page, {N}, {CONV} FROM mart GROUP BY 1
      ORDER BY sessions DESC, landing_page NULLS FIRST LIMIT 20""")
add("sessions_by_region", lambda w: metrics.sessions_by_region(w.mart_sessions()),
    f"SELECT country, region, {N}, {CONV} FROM mart GROUP BY 1, 2")
add("top_cities", lambda w: metrics.top_cities(w.mart_sessions()),
    f"""SELECT city, {N}, {CONV} FROM mart GROUP BY 1
      ORDER BY sessions DESC, city NULLS FIRST LIMIT 20""")
add("conversion_rate_by_os", lambda w: metrics.conversion_rate_by_os(w.mart_sessions()),
    f"SELECT operating_system, {RATE} FROM mart GROUP BY 1")
add("apply_filters", lambda w: metrics.kpi_overview(metrics.apply_filters(
    w.mart_sessions(), back(w, 7), day(w), ["Paid Search", "Social", "Other"],
    ["Canada", "Spain", "Japan"], ["mobile", "desktop", "tablet"],
    {"landing_page": "a.com"})),
    f"""SELECT {KPIS.replace("sum(conversions) * 100.0 / count(*)",
        "sum(conversions) * 100.0 / nullif(count(*), 0)")} FROM mart
      WHERE session_date BETWEEN {O.back(7)} AND {RUN}
      AND channel_group IN ('Paid Search', 'Social', 'Other')
      AND country IN ('Canada', 'Spain', 'Japan')
      AND device_category IN ('mobile', 'desktop', 'tablet')
      AND contains(landing_page, 'a.com')""")
add("detail_table", lambda w: metrics.detail_table(w.mart_sessions()),
    f"SELECT channel_group, utm_campaign, country, {N}, {CONV} FROM mart GROUP BY 1, 2, 3")
add("channel_type_table", lambda w: metrics.channel_type_table(w.mart_sessions()),
    f"SELECT channel_group, channel_type, {N}, {CONV}, {RATE} FROM mart GROUP BY 1, 2")


# --- the same tiles from the daily rollup ---


def rolled(name: str, tile_set: str, dimensions: list[str], *measures: str,
           report: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Registers a tile over the written rollup with the SQL of its form over the mart."""
    add(f"{name}_rolled", lambda w: report(rollup.tile(
        w.table("mart_rollup"), tile_set, dimensions, *measures)))
    SQL[f"{name}_rolled"] = SQL[name]


_SETS_SQL = ", ".join(f"({', '.join(['session_date', *dims])})" for dims in rollup.SETS.values())
_SET_SQL = " ".join(
    f"WHEN {sum(1 << (len(rollup.DIMENSIONS) - 1 - i) for i, c in enumerate(rollup.DIMENSIONS) if c not in dims)}"
    f" THEN '{name}'" for name, dims in rollup.SETS.items())
add("mart_rollup", lambda w: w.table("mart_rollup").drop("users", "lengths"),
    f"""SELECT session_date, CASE grouping_id({', '.join(rollup.DIMENSIONS)}) {_SET_SQL} END
      AS tile_set, {', '.join(rollup.DIMENSIONS)}, {N}, {CONV}, {LEADS}, {ENGAGED}, {VALUE},
      CAST(sum(session_duration_seconds) AS BIGINT) AS seconds,
      count(session_duration_seconds) AS timed FROM mart GROUP BY GROUPING SETS ({_SETS_SQL})""")
rolled("kpi_overview", "total", [], "sessions", "conversions", "conversion_rate", "avg_duration_min",
       "leads", "engaged_sessions")
rolled("channel_rates", "channel", ["channel_group"], "conversion_rate", "lead_rate", "engaged_rate",
       "revenue_per_session", "bounce_rate", "avg_duration_min")
rolled("sessions_by_device", "device", ["device_category"], "sessions", "conversions", "conversion_rate")
rolled("conversion_rate_by_os", "device", ["operating_system"], "conversion_rate")
rolled("top_countries", "place", ["country"], "sessions", "conversions", "conversion_rate",
       report=lambda df: metrics.top(df, 10, "sessions", "country"))
rolled("sessions_by_region", "place", ["country", "region"], "sessions", "conversions")
rolled("top_cities", "place", ["city"], "sessions", "conversions",
       report=lambda df: metrics.top(df, 20, "sessions", "city"))
rolled("channel_date_heatmap", "channel", ["channel_group", "session_date"], "sessions", "conversions")
rolled("campaign_performance", "campaign", metrics.CAMPAIGN, "sessions", "conversions",
       "conversion_rate", "total_conversion_value")
rolled("top_landing_pages", "page", ["landing_page"], "sessions", "conversions",
       report=lambda df: metrics.top(df, 20, "sessions", "landing_page"))
add("sessions_by_date_rolled", lambda w: rollup.tile(
    metrics.since(w.table("mart_rollup"), back(w, 30)), "total", ["session_date"], "sessions",
    "conversions"))
SQL["sessions_by_date_rolled"] = SQL["sessions_by_date"]


def estimates(w: Warehouse) -> DataFrame:
    """Distinct users and length percentiles per channel: whether the sketches are within bounds."""
    users = rollup.tile(w.table("mart_rollup"), "channel", ["channel_group"], "approx_users")
    lengths = rollup.length_percentiles(w.table("mart_rollup"), "channel", ["channel_group"])
    seconds = F.col("session_duration_seconds")
    shares = {"p50_seconds": 0.5, "p90_seconds": 0.9}
    exact = w.mart_sessions().join(F.broadcast(lengths), "channel_group").groupBy(
        "channel_group").agg(
        F.count_distinct("user_pseudo_id").alias("n"), F.count(seconds).alias("timed"),
        *[F.count_if(seconds < F.col(c)).alias(f"{c}_below") for c in shares],
        *[F.count_if(seconds <= F.col(c)).alias(f"{c}_up_to") for c in shares])

    def near(column: str) -> F.Column:
        """The estimate lies between the values a little below and above its rank: lengths are
        counted on either side of it, none is collected or sorted."""
        def rank(r: float) -> F.Column:
            return F.greatest(F.lit(1), F.least(F.col("timed"), F.ceil(F.col("timed") * r)))
        low, high = (rank(shares[column] + d * rollup.RANK_ERROR) for d in (-2, 2))
        return (F.col(f"{column}_up_to") >= low) & (F.col(f"{column}_below") < high)

    return exact.join(users, "channel_group").select(
        "channel_group", (F.abs(F.col("approx_users") - F.col("n")) <= F.ceil(
            4 * rollup.USERS_ERROR * F.col("n"))).alias("users_within_bound"),
        (near("p50_seconds") & near("p90_seconds")).alias("lengths_within_bound"))


add("rollup_estimates", estimates,
    """SELECT channel_group, true AS users_within_bound, true AS lengths_within_bound FROM mart
      GROUP BY 1""")
add("mart_rows_last_7", lambda w: metrics.mart_rows(
    metrics.since(w.mart_sessions(), back(w, 7))),
    f"SELECT count(*) AS total_sessions FROM mart WHERE session_date >= {O.back(7)}")
add("monthly_sessions", lambda w: metrics.monthly_sessions(w.mart_sessions()),
    f"SELECT year, month, {N}, {CONV} FROM mart GROUP BY 1, 2")

# --- quality ---------------------------------------------------------------------------------

DAY_FLAT = f"flat WHERE event_date_partition = {RUN}"
DAY_SESS = f"sess WHERE session_date = {RUN}"
CHECK_INPUT: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_events_flat": flat_day, "stg_sessions": sessions_day, "fact_sessions": fact_day}


def check(name: str, sql: str) -> None:
    c = quality.CHECKS[name]
    source = CHECK_INPUT[c.table]
    add(name, lambda w: c.report(source(w)), sql)


def passed(cond: str) -> str:
    return f"if({cond}, 'PASS', 'FAIL') AS status"


check("stage_events_volume", f"""SELECT 'stage_events_volume' AS assertion_name,
      count(*) AS events_count, {passed("count(*) > 0")} FROM {DAY_FLAT}""")
check("stage_events_missing_session_id", f"""SELECT 'stage_events_missing_session_id'
      AS assertion_name, count(*) - count(ga_session_id) AS events_without_session,
      count(*) AS events_total,
      {passed("count(*) - count(ga_session_id) < count(*) * 0.01")} FROM {DAY_FLAT}""")
check("stage_sessions_volume", f"""SELECT 'stage_sessions_volume' AS assertion_name,
      count(*) AS sessions_count, {passed("count(*) > 0")} FROM {DAY_SESS}""")
check("stage_sessions_negative_duration", f"""SELECT 'stage_sessions_negative_duration'
      AS assertion_name, count(*) FILTER (session_duration_seconds < 0)
      AS sessions_negative_duration,
      {passed("count(*) FILTER (session_duration_seconds < 0) = 0")} FROM {DAY_SESS}""")
check("stage_sessions_events_distribution", f"""SELECT 'stage_sessions_events_distribution'
      AS assertion_name, round(avg(events_count), 4) AS avg_events_per_session,
      round(stddev_samp(events_count), 4) AS stddev_events_per_session,
      {passed("avg(events_count) BETWEEN 1 AND 1000")} FROM {DAY_SESS}""")
check("stage_sessions_unique", f"""SELECT 'stage_sessions_unique' AS assertion_name,
      count(*) AS total_sessions, count(DISTINCT session_id) AS unique_sessions,
      {passed("count(*) = count(DISTINCT session_id)")} FROM {DAY_SESS}""")
check("stage_events_critical_fields", f"""SELECT 'stage_events_critical_fields'
      AS assertion_name, count(*) AS total_events, count(*) - count(event_name)
      AS null_event_name, count(*) - count(user_pseudo_id) AS null_user_id,
      count(*) - count(event_timestamp) AS null_timestamp,
      {passed("count(event_name) + count(user_pseudo_id) + count(event_timestamp) "
              "= 3 * count(*)")} FROM {DAY_FLAT}""")
check("olap_fact_sessions_volume", f"""SELECT 'olap_fact_sessions_volume' AS assertion_name,
      count(*) AS sessions_count, {passed("count(*) > 0")} FROM g_sessions
      WHERE session_date = {RUN}""")
for _dim, _column in quality.REFERENCES.items():
    _cte = _dim.replace("dim_", "")
    add(f"olap_fact_sessions_{_dim}_integrity",
        lambda w, d=_dim: quality.integrity(
            fact_day(w), w.table("dim_date") if d == "dim_date" else w.dim(d, True), d),
        f"""SELECT 'olap_fact_sessions_{_dim}_integrity' AS assertion_name,
          count(*) AS orphan_sessions, {passed("count(*) = 0")} FROM g_sessions AS f
          WHERE session_date = {RUN} AND NOT EXISTS
          (FROM {_cte}_keys AS d WHERE d.{_column} = f.{_column})""")
add("olap_fact_sessions_consistency",
    lambda w: quality.consistency(fact_day(w), sessions_day(w)),
    f"""SELECT 'olap_fact_sessions_consistency' AS assertion_name, a AS fact_count,
      b AS stage_count, {passed("abs(a - b) <= 5")}
      FROM (SELECT count(*) AS a FROM g_sessions WHERE session_date = {RUN}),
      (SELECT count(*) AS b FROM {DAY_SESS})""")
add("olap_conformed_consistency", lambda w: quality.consistency(
    w.table("fact_sessions"), sessions_table(w)),
    f"""SELECT 'olap_fact_sessions_consistency' AS assertion_name, a AS fact_count,
      b AS stage_count, {passed("abs(a - b) <= 5")}
      FROM (SELECT count(*) AS a FROM g_sessions), (SELECT count(*) AS b FROM sess)""")
add("olap_dimensions_not_empty", lambda w: quality.not_empty(
    {**w.dims(), "dim_date": w.table("dim_date")}),
    f"""SELECT 'olap_dimensions_not_empty' AS assertion_name, a AS dim_date_count,
      b AS dim_device_count, c AS dim_geo_count, d AS dim_channel_count,
      {passed("a > 0 AND b > 0 AND c > 0 AND d > 0")}
      FROM (SELECT count(*) AS a FROM d_date), (SELECT count(*) AS b FROM d_device),
      (SELECT count(*) AS c FROM d_geo), (SELECT count(*) AS d FROM d_channel)""")
add("olap_dim_date_unique_keys", lambda w: quality.CHECKS["olap_dim_date_unique_keys"].report(
    calendar_with_volume(w)),
    f"""SELECT 'olap_dim_date_unique_keys' AS assertion_name, count(*) AS total_rows,
      count(DISTINCT date_key) AS unique_keys,
      {passed("count(*) = count(DISTINCT date_key)")} FROM d_date""")
add("olap_dim_device_unique_keys", lambda w: quality.CHECKS[
    "olap_dim_device_unique_keys"].report(w.dim("dim_device")),
    f"""SELECT 'olap_dim_device_unique_keys' AS assertion_name, count(*) AS total_rows,
      count(DISTINCT device_key) AS unique_keys,
      {passed("count(*) = count(DISTINCT device_key)")} FROM d_device""")
add("raw_duplicate_param_keys", lambda w: quality.duplicate_param_keys(w.export),
    f"""SELECT 'raw_duplicate_param_keys' AS assertion_name,
      count(*) FILTER (len(k) <> len(list_distinct(k))) AS events_with_duplicate_keys,
      {passed("count(*) FILTER (len(k) <> len(list_distinct(k))) = 0")}
      FROM (SELECT list_concat(['session_engaged', 'page_title'], {" || ".join(
          f"if({c} IS NULL, [], ['{c}'])" for c in (
              "ga_session_id", "page_location", "page_referrer", "utm_source", "utm_medium",
              "utm_campaign", "utm_term", "utm_content", "lead_id", "conversion_value"))}) AS k
      FROM flat)""")
add("stage_events_conversion_value", lambda w: quality.bad_amounts(flat_table(w)),
    f"""SELECT 'stage_events_conversion_value' AS assertion_name, count(*) AS unreadable_values,
      {passed("count(*) = 0")} FROM flat WHERE conversion_value IS NOT NULL
      AND TRY_CAST(conversion_value AS DOUBLE) IS NULL""")


def value_check_sql(name: str, source: str, expected: int) -> str:
    return f"""SELECT '{name}' AS check_name, count(*) AS value,
      CAST({expected} AS BIGINT) AS pass_value, if(count(*) BETWEEN {expected * 0.9}
      AND {expected * 1.1}, 'PASS', 'FAIL') AS tolerance_status,
      if(count(*) >= {expected}, 'PASS', 'FAIL') AS minimum_status FROM {source}"""


add("check_value_tolerance", lambda w: quality.value_checks(
    flat_day(w), sessions_day(w), fact_day(w)),
    " UNION ALL ".join([
        value_check_sql("check_events_volume", DAY_FLAT, V.EXPECTED_EVENTS),
        value_check_sql("check_sessions_volume", DAY_SESS, V.EXPECTED_SESSIONS),
        value_check_sql("check_fact_sessions_volume",
                        f"g_sessions WHERE session_date = {RUN}", V.EXPECTED_FACTS)]))
add("check_truthy", lambda w: quality.truthy(flat_day(w), "dq_stage_events").unionByName(
    quality.truthy(sessions_day(w), "dq_stage_sessions")),
    f"""SELECT 'dq_stage_events' AS check_name, count(*) AS value, count(*) > 0 AS passed
      FROM {DAY_FLAT} UNION ALL SELECT 'dq_stage_sessions', count(*), count(*) > 0
      FROM {DAY_SESS}""")
add("run_assertions", lambda w: w.quality_log(), "SELECT * FROM dq_history")

# --- audit, alerts, trends ---------------------------------------------------------------------

GBS = "R2<sum(bytes_processed) / 1e9>R2 AS total_gb_processed"
add("vw_recent_runs", lambda w: monitor.recent_runs(w.run_log, back(w, 7)),
    f"""SELECT run_id, run_date, dag_id, task_id, status, rows_processed,
      R2<bytes_processed / 1e9>R2 AS bytes_processed_gb, duration_seconds, error_message,
      run_timestamp FROM rlog WHERE run_date >= {O.back(7)}""")
add("vw_daily_summary", lambda w: monitor.runs_by_day(w.run_log, back(w, 30)),
    f"""SELECT run_date, dag_id, count(*) AS total_runs,
      count(*) FILTER (status = 'success') AS successful_runs,
      count(*) FILTER (status = 'failed') AS failed_runs,
      CAST(sum(rows_processed) AS BIGINT) AS total_rows_processed,
      R2<sum(bytes_processed) / 1e12>R2 AS total_bytes_processed_tb,
      round(avg(duration_seconds), 4) AS avg_duration_seconds FROM rlog
      WHERE run_date >= {O.back(30)} GROUP BY 1, 2""")
add("daily_summary", lambda w: monitor.daily_summary(
    day(w), flat_day(w), sessions_day(w), fact_day(w),
    raw.scan_partition(w.table("fact_conversions"), "conversion_date", day(w))),
    f"""SELECT {RUN} AS report_date, (SELECT count(*) FROM {DAY_FLAT}) AS events_count,
      (SELECT count(*) FROM {DAY_SESS}) AS sessions_count,
      (SELECT count(*) FROM g_sessions WHERE session_date = {RUN}) AS fact_sessions_count,
      (SELECT count(*) FROM g_conversions WHERE conversion_date = {RUN})
        AS conversions_count""")
add("alert_missing_daily_data", lambda w: monitor.missing_daily_data(flat_table(w), day(w)),
    f"""SELECT 'missing_daily_data' AS alert_type, {RUN} AS check_date,
      {passed("count(*) > 0")}, count(*) AS events_count FROM {DAY_FLAT}""")
add("alert_volume_drop", lambda w: monitor.volume_drop(flat_table(w), day(w), back(w, 7)),
    f"SELECT * FROM ({CHANGES_SQL}) WHERE check_date = {RUN}")
add("alert_data_quality_failure", lambda w: monitor.quality_failures(w.quality_log(), day(w)),
    f"""SELECT 'data_quality_failure' AS alert_type, check_date,
      count(*) FILTER (status = 'FAIL') AS failed_assertions, count(*) AS total_assertions,
      {passed("count(*) FILTER (status = 'FAIL') = 0")} FROM dq_history
      WHERE check_date = {RUN} GROUP BY check_date""")
FAILED_SQL = """SELECT 'dag_failure' AS alert_type, run_date, dag_id, count(*) AS failed_tasks,
      string_agg(DISTINCT error_message, '; ' ORDER BY error_message) AS error_messages
      FROM rlog WHERE status = 'failed'"""
add("alert_dag_failure", lambda w: monitor.failed_jobs(w.run_log, day(w)),
    f"{FAILED_SQL} AND run_date = {RUN} GROUP BY run_date, dag_id")
add("dag_failures_all_days", lambda w: monitor.failed_jobs(w.run_log),
    f"{FAILED_SQL} GROUP BY run_date, dag_id")
COST_SQL = """SELECT 'high_query_cost' AS alert_type, CAST(creation_time AS DATE) AS query_date,
      count(*) AS high_cost_queries, R2<sum(total_bytes_billed) / 1e12>R2 AS total_tb_billed
      FROM qlog WHERE total_bytes_billed > 1e12 AND creation_time >= {}
      GROUP BY 2 HAVING total_tb_billed > 5"""
add("alert_high_query_cost", lambda w: monitor.high_query_cost(w.query_log, back(w, 1)),
    COST_SQL.format(O.back(1)))
add("failure_messages", lambda w: monitor.failure_messages(w.run_log),
    """SELECT run_date, dag_id, error_message, count(*) AS n FROM rlog WHERE status = 'failed'
      GROUP BY 1, 2, 3""")
BIG = "total_logical_bytes / 1e9"
# Limits that the supplied tables reach; the operators' own defaults are the published ones.
SMALL_GB, LARGE_GB = 2e-6, 1e-5
add("alert_large_partition", lambda w: monitor.large_partitions(
    w.partition_stats(), day(w), SMALL_GB),
    f"""SELECT 'large_partition' AS alert_type, table_name, partition_id,
      R2<{BIG}>R2 AS size_gb, total_rows, 'WARNING' AS status FROM pstats
      WHERE {BIG} > {SMALL_GB:.9f} AND partition_id = '{O.P.run_date}'""")
add("runs_by_task", lambda w: monitor.runs_by_task(w.run_log, back(w, 7)),
    f"""SELECT dag_id, task_id, status, count(*) AS execution_count,
      round(avg(duration_seconds), 4) AS avg_duration_seconds,
      CAST(sum(rows_processed) AS BIGINT) AS total_rows, {GBS} FROM rlog
      WHERE run_date >= {O.back(7)} GROUP BY 1, 2, 3""")
add("volume_trend", lambda w: monitor.volume_trend(sessions_table(w), back(w, 30)),
    f"""SELECT event_date_partition AS date, count(*) AS events_count,
      count(DISTINCT session_id) AS unique_sessions,
      count(DISTINCT user_pseudo_id) AS unique_users,
      R2<count(*) / nullif(count(DISTINCT session_id), 0)>R2 AS avg_events_per_session
      FROM flat WHERE event_date_partition >= {O.back(30)} GROUP BY 1""")
add("query_performance", lambda w: monitor.query_performance(w.query_log, back(w, 7)),
    f"""SELECT CAST(creation_time AS DATE) AS query_date, count(*) AS total_queries,
      count(*) FILTER (total_bytes_billed > 1e9) AS large_queries,
      R2<avg(total_bytes_billed) / 1e9>R2 AS avg_gb_billed,
      R2<sum(total_bytes_billed) / 1e12>R2 AS total_tb_billed,
      R2<avg(total_slot_ms) / 1000>R2 AS avg_slot_seconds FROM qlog
      WHERE statement_type = 'SELECT' AND creation_time >= {O.back(7)} GROUP BY 1""")
add("conversion_by_channel", lambda w: monitor.conversion_by_channel(
    w.table("fact_sessions"), w.dim("dim_channel", True), back(w, 30)),
    f"""SELECT channel_group, channel_type, count(DISTINCT session_id) AS sessions,
      count(*) FILTER (has_conversion) AS conversions,
      round(sum(total_conversion_value), 4) AS total_conversion_value,
      R2<count(*) FILTER (has_conversion) / nullif(count(DISTINCT session_id), 0) * 100>R2
        AS conversion_rate
      FROM g_sessions LEFT JOIN c_channel USING (channel_key)
      WHERE session_date >= {O.back(30)} GROUP BY 1, 2""")
add("pipeline_health", lambda w: monitor.pipeline_health(w.run_log, w.params.as_of),
    f"""SELECT dag_id, last_run, last_run_date, CASE
      WHEN last_run_date < {AS_OF} - 2 THEN 'STALE'
      WHEN EXISTS (FROM rlog AS r WHERE r.dag_id = l.dag_id AND r.run_date = l.last_run_date
        AND r.status = 'failed') THEN 'FAILED' ELSE 'HEALTHY' END AS health_status
      FROM (SELECT dag_id, max(run_timestamp) AS last_run, max(run_date) AS last_run_date
      FROM rlog GROUP BY 1) AS l""")

# --- table health ----------------------------------------------------------------------------

add("partition_stats", lambda w: w.partition_stats(), "SELECT * FROM pstats")
add("partition_stats_newest", lambda w: monitor.newest_partitions(
    w.partition_stats().where(F.col("table_name") == "stg_events_flat"), 10),
    """SELECT * FROM pstats WHERE table_name = 'stg_events_flat'
      ORDER BY partition_id DESC LIMIT 10""")
add("partition_file_sizes", lambda w: monitor.file_stats(
    w.spark, w.path("stg_events_flat"), "stg_events_flat", "event_date_partition").select(
        "table_name", "partition_id", (F.col("files") > 0).alias("has_files"),
        (F.col("file_bytes") > 0).alias("has_bytes")),
    """SELECT DISTINCT 'stg_events_flat' AS table_name,
      strftime(event_date_partition, '%Y-%m-%d') AS partition_id, true AS has_files,
      true AS has_bytes FROM flat""")
# Sizes depend on the writer, so these have no SQL; a test holds them against the folder.
add("partition_file_bytes", lambda w: monitor.file_stats(
    w.spark, w.path("stg_events_flat"), "stg_events_flat", "event_date_partition"))
add("partition_report", lambda w: monitor.partition_report(
    w.partition_stats(), back(w, 7)),
    f"""SELECT table_name, partition_id, total_rows, R2<{BIG}>R2 AS size_gb,
      R2<total_logical_bytes / 1e12>R2 AS size_tb FROM pstats
      WHERE partition_id >= '{O.P.days_back(7)}'""")
add("partition_size_recommendation", lambda w: monitor.size_recommendation(
    w.partition_stats(), small_gb=SMALL_GB, large_gb=LARGE_GB),
    f"""SELECT table_name, partition_id, R2<{BIG}>R2 AS size_gb, total_rows,
      CASE WHEN {BIG} < {SMALL_GB:.9f} THEN '{V.PARTITION_TOO_SMALL}'
      WHEN {BIG} > {LARGE_GB:.9f} THEN '{V.PARTITION_TOO_LARGE}' ELSE '{V.PARTITION_OPTIMAL}' END
      AS recommendation FROM pstats ORDER BY table_name, partition_id DESC LIMIT 20""")
add("partition_usage", lambda w: monitor.partition_usage(w.partition_stats()),
    """SELECT table_name, count(DISTINCT partition_id) AS num_partitions,
      min(partition_id) AS oldest_partition, max(partition_id) AS newest_partition,
      CAST(sum(total_rows) AS BIGINT) AS total_rows,
      R2<sum(total_logical_bytes) / 1e12>R2 AS total_size_tb FROM pstats GROUP BY 1""")
LARGE_SQL = f"""FROM qlog WHERE creation_time >= {O.back(7)} AND statement_type = 'SELECT'"""
TOP_READ = "ORDER BY total_bytes_processed DESC, job_id LIMIT 10"
add("expensive_queries", lambda w: monitor.expensive_queries(w.query_log, back(w, 7)),
    f"""SELECT job_id, creation_time, total_bytes_processed, total_bytes_billed, query
      {LARGE_SQL} AND total_bytes_processed > 1e9 {TOP_READ}""")
add("costliest_queries", lambda w: monitor.costliest_queries(w.query_log, back(w, 7)),
    f"""SELECT job_id, creation_time, total_bytes_processed, total_bytes_billed, total_slot_ms
      FROM qlog WHERE creation_time >= {O.back(7)}
      ORDER BY total_bytes_billed DESC, job_id LIMIT 10""")
add("clustering_benefit", lambda w: monitor.clustering_benefit(w.query_log, back(w, 1)),
    f"""SELECT job_id, creation_time, total_bytes_processed, total_bytes_billed,
      substr(query, 1, 100) AS query_preview {LARGE_SQL.replace(O.back(7), O.back(1))}
      AND total_bytes_processed > 0 AND total_bytes_processed < total_bytes_billed * 0.5
      {TOP_READ}""")
add("clustering_labels", lambda w: monitor.clustering_labels(w.query_log, back(w, 1)),
    f"""SELECT job_id, total_bytes_processed, total_bytes_billed,
      if(total_bytes_processed < total_bytes_billed * 0.5, '{V.CLUSTERING_EFFECTIVE}',
      '{V.CLUSTERING_NOT_EFFECTIVE}') AS clustering_effectiveness
      {LARGE_SQL.replace(O.back(7), O.back(1))} {TOP_READ}""")
add("partitions_queried", lambda w: monitor.partitions_queried(
    w.query_log, back(w, 7), "stg_events_flat"),
    f"""SELECT CAST(creation_time AS DATE) AS query_date, count(*) AS query_count,
      count(DISTINCT split_part(query, '''', 2)) AS unique_partitions_queried FROM qlog
      WHERE creation_time >= {O.back(7)} AND contains(query, 'stg_events_flat') GROUP BY 1""")

# --- streams ---------------------------------------------------------------------------------


def streamed(w: Warehouse, name: str, start: Callable, files_per_batch: int = 5) -> str:
    """Runs a job over the written export in many batches; returns its folder."""
    path = w.fresh(f"stream_{name}")
    source = jobs.open_stream(w.spark, w.path("raw_events"), files_per_batch=files_per_batch)
    start(source, path, f"{path}_checkpoint").awaitTermination()
    return path


def stream_flatten(w: Warehouse) -> DataFrame:
    return w.spark.read.parquet(streamed(w, "flatten", jobs.stream_flatten))


def stream_volume(w: Warehouse) -> DataFrame:
    """The sketch's estimate stands for itself as whether it is within 5 % of the true count."""
    path = streamed(w, "volume", lambda *a: jobs.stream_volume(*a, every=4))
    exact = flat_table(w).groupBy(F.col("event_date_partition").alias("date")).agg(
        F.count_distinct("session_id").alias("n"))
    near = F.abs(F.col("approx_sessions") - F.col("n")) <= 0.05 * F.col("n")
    return jobs.daily_volume(w.spark, path).join(exact, "date").select(
        "date", "events_count", "events_with_session", near.alias("sessions_within_bound"))


def stream_sessions(w: Warehouse) -> DataFrame:
    return jobs.sessions_so_far(w.spark, streamed(
        w, "sessions", lambda *a: jobs.stream_sessions(*a, every=4)))


def stream_gap_sessions(w: Warehouse) -> DataFrame:
    return jobs.gap_sessions_so_far(w.spark, streamed(w, "gaps", jobs.stream_gap_sessions))


def stream_upsert(w: Warehouse) -> DataFrame:
    table: Table = TABLES["fact_events"]
    path = streamed(w, "upsert", lambda source, out, checkpoint: jobs.stream_upsert_events(
        source, w.dims(True, True), table, out, f"{out}_staging", checkpoint), 10)
    return tables.read_table(w.spark, path, table.schema).drop("_etl_timestamp")


def heartbeat_alerts(w: Warehouse) -> DataFrame:
    """The volume stream, then a heartbeat two days after the last event."""
    volumes = streamed(w, "heartbeat", lambda *a: jobs.stream_volume(*a, every=4), 40)
    beats, out = w.fresh("beats"), w.fresh("alerts")
    (flat_table(w).agg(F.max("event_date_partition").alias("d")).select(
        F.date_add("d", 3).cast("timestamp").alias("timestamp")).write.parquet(beats))
    source = w.spark.readStream.schema("timestamp timestamp").parquet(beats)
    jobs.stream_alerts(source, volumes, out, f"{out}_checkpoint", 400).awaitTermination()
    return jobs.open_alerts(w.spark, out).drop("as_of")


EVERY_DAY = """(SELECT date, coalesce(events_count, 0) AS n, lag(coalesce(events_count, 0)) OVER (
      ORDER BY date) AS p FROM (SELECT CAST(unnest(generate_series(min(date), max(date) + 2,
      INTERVAL 1 DAY)) AS DATE) AS date FROM vol) LEFT JOIN vol USING (date))"""
add("stream_heartbeat_alerts", heartbeat_alerts,
    f"""SELECT 'missing_daily_data' AS alert_type, date AS check_date, if(n > 0, 'PASS', 'FAIL') AS status,
      n AS events_count, NULL::BIGINT AS previous_count, NULL::DOUBLE AS pct_change FROM {EVERY_DAY}
      UNION ALL SELECT 'volume_drop', date, if((n - p) * 100.0 / nullif(p, 0) < -20, 'FAIL', 'PASS'),
      n, p, R2<(n - p) * 100.0 / nullif(p, 0)>R2 FROM {EVERY_DAY}""")
add("stream_flatten", stream_flatten, "SELECT * FROM flat")
add("stream_volume", stream_volume,
    """SELECT event_date_partition AS date, count(*) AS events_count,
      count(session_id) AS events_with_session, true AS sessions_within_bound
      FROM flat GROUP BY 1""")
add("stream_sessions", stream_sessions,
    f"""SELECT {', '.join(c for c in O.SESSION_COLUMNS if c != 'unique_events_count')}
      FROM sess_event""")
add("stream_gap_sessions", stream_gap_sessions)
SQL["stream_gap_sessions"] = SQL["gap_sessions"]
add("stream_upsert_events", stream_upsert, "SELECT * FROM g_events")
