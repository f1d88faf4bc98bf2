"""The registered queries in DuckDB SQL, for comparison.

Written apart from the Spark side: the flat table is stated directly from the
derivation rules of the supplied events, without building or reading the nested
export. Shared pieces are named CTEs; a query gets those it mentions.
"""

from __future__ import annotations

import re

from clickstar import fixed_values as V
from clickstar.operators import stage
from clickstar.params import RunParams

P = RunParams()


def _day(value) -> str:
    return f"DATE '{value}'"


RUN, AS_OF = _day(P.run_date), _day(P.as_of)


def back(days: int) -> str:
    return _day(P.days_back(days))


def _in(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _table_case(column: str, table: list[tuple[str, list[str]]]) -> str:
    whens = " ".join(f"WHEN {column} IN {_in(names)} THEN '{label}'" for label, names in table)
    return f"CASE {whens} ELSE '{V.OTHER}' END"


def _channel_case() -> str:
    whens = []
    for label, spec in V.CHANNEL_GROUPS:
        parts = [f"{c} IN {_in(spec[c])}" for c in ("source", "medium") if c in spec]
        if "medium_contains" in spec:
            parts.append(f"contains(medium, '{spec['medium_contains']}')")
        whens.append(f"WHEN {' AND '.join(parts)} THEN '{label}'")
    return f"CASE {' '.join(whens)} ELSE '{V.OTHER}' END"


def _known(*columns: str) -> str:
    return ", ".join(f"coalesce({c}, 'unknown') AS {c}" for c in columns)


def _key(*columns: str) -> str:
    return f"sha256(concat_ws('|', {', '.join(columns)}))"


def _firsts(picks: dict[str, str], order: str) -> str:
    return ", ".join(f"first({c} ORDER BY {order}) AS {n}" for c, n in picks.items())


UNKNOWN2, UNKNOWN3 = "sha256('unknown|unknown')", "sha256('unknown|unknown|unknown')"

EVENT_ORDER = "event_timestamp, src_event_id"
_ENTRY = {"page_location": "landing_page", "device_category": "device_category",
          "device_os": "device_os", "country": "country", "region": "region", "city": "city",
          "utm_source": "s1", "traffic_source_source": "s2", "utm_medium": "m1",
          "traffic_source_medium": "m2", "utm_campaign": "campaign", "utm_term": "term",
          "utm_content": "content"}


def _sessions(grain: str, group: str, clock: str) -> str:
    return f"""
    SELECT * EXCLUDE (s1, s2, m1, m2), coalesce(s1, s2) AS source, coalesce(m1, m2) AS medium,
      (epoch_us(session_end_timestamp) // 1000000 - epoch_us(session_start_timestamp) // 1000000)
        - CASE WHEN epoch_us(session_end_timestamp) % 1000000
                  < epoch_us(session_start_timestamp) % 1000000 THEN 1 ELSE 0 END
        AS session_duration_seconds
    FROM (SELECT {grain},
      min({clock}) AS session_start_timestamp, max({clock}) AS session_end_timestamp,
      count(*) AS events_count, count(DISTINCT event_name) AS unique_events_count,
      count(*) FILTER (event_name = 'page_view') AS pageviews,
      count(*) FILTER (event_name = 'scroll') AS scrolls,
      bool_or(is_conversion_event) AS has_conversion, bool_or(is_lead_event) AS has_lead,
      count(*) FILTER (is_conversion_event) AS conversion_events_count,
      count(*) FILTER (is_lead_event) AS lead_events_count,
      round(sum(CAST(conversion_value AS DOUBLE)), 4) AS total_conversion_value,
      max(purchase_revenue) AS max_purchase_revenue,
      round(sum(purchase_revenue), 4) AS total_purchase_revenue,
      {_firsts(_ENTRY, EVENT_ORDER)},
      last(page_location ORDER BY {EVENT_ORDER}) AS exit_page,
      max(session_engaged) AS session_engaged
    FROM flat {group})"""


def _lookup_joins(side: str, values: dict[str, dict[str, str]], prefix: str) -> str:
    joins = []
    for dim, pairs in values.items():
        on = " AND ".join(f"{expr} = {dim}.{c}" for c, expr in pairs.items())
        joins.append(f"LEFT JOIN {prefix}_{dim} AS {dim} ON {on}")
    return f"{side} " + " ".join(joins)


def _u(*parts: str) -> str:
    return f"coalesce({', '.join(parts)}, 'unknown')"


_SESSION_VALUES = {
    "device": {"device_category": _u("x.device_category"), "operating_system": _u("x.device_os")},
    "geo": {c: _u(f"x.{c}") for c in ("country", "region", "city")},
    "campaign": {"utm_source": _u("x.source"), "utm_medium": _u("x.medium"),
                 "utm_campaign": _u("x.campaign")},
    "channel": {"source": _u("x.source"), "medium": _u("x.medium")},
}
_EVENT_VALUES = {
    "device": _SESSION_VALUES["device"], "geo": _SESSION_VALUES["geo"],
    "campaign": {c: _u(f"x.{c}") for c in ("utm_source", "utm_medium", "utm_campaign")},
    "channel": {"source": _u("x.utm_source", "x.traffic_source_source"),
                "medium": _u("x.utm_medium", "x.traffic_source_medium")},
    "event": {"event_name": "x.event_name"},
}
_KEYS = {"device": "device_key", "geo": "geo_key", "campaign": "campaign_key",
         "channel": "channel_key", "event": "event_type_key"}
_UNKNOWN_KEYS = {"device": UNKNOWN2, "geo": UNKNOWN3, "campaign": UNKNOWN3,
                 "channel": "sha256('unknown|unknown|Other')", "event": "sha256('unknown')"}


def _key_columns(dims, conformed: bool) -> str:
    def one(d: str) -> str:
        if conformed:
            return f"coalesce({d}.{_KEYS[d]}, {_UNKNOWN_KEYS[d]}) AS {_KEYS[d]}"
        return f"{d}.{_KEYS[d]}"
    return ", ".join(one(d) for d in dims)


def _fact_sessions(prefix: str, conformed: bool) -> str:
    source, grain = ("sess_event", ", ga_session_id") if conformed else ("sess", "")
    return f"""
    SELECT session_id, session_date, user_pseudo_id, user_id, session_date AS date_key,
      {_key_columns(_SESSION_VALUES, conformed)},
      session_start_timestamp, session_end_timestamp, session_duration_seconds, events_count,
      pageviews, has_conversion, has_lead, session_engaged, total_conversion_value,
      total_purchase_revenue, landing_page, exit_page{grain}
    FROM {_lookup_joins(f"{source} AS x", _SESSION_VALUES, prefix)}"""


_IDENTITY = ("coalesce(x.session_id, x.user_pseudo_id || '_') || '_' || x.event_timestamp "
             "|| '_' || x.event_name || '_' || x.src_event_id")


def _fact_events(prefix: str, conformed: bool, source: str = "flat") -> str:
    if conformed:
        identity, at = _IDENTITY, "make_timestamp(x.event_timestamp)"
    else:
        identity = "x.session_id || '_' || x.event_timestamp || '_' || x.event_name"
        at = "x.event_timestamp_date"
    return f"""
    SELECT {identity} AS event_id, x.event_date_partition AS event_date,
      {at} AS event_timestamp, x.session_id, x.user_pseudo_id, x.user_id,
      x.event_date_partition AS date_key, {_key_columns(_EVENT_VALUES, conformed)},
      x.event_name, x.page_location, x.page_title, x.is_conversion_event, x.is_lead_event,
      CAST(x.conversion_value AS DOUBLE) AS conversion_value, x.purchase_revenue
    FROM {_lookup_joins(f"{source} AS x", _EVENT_VALUES, prefix)}"""


def _fact_conversions(prefix: str, conformed: bool, source: str = "conv") -> str:
    if conformed:
        identity, at = _IDENTITY, "make_timestamp(x.event_timestamp)"
    else:
        identity = ("x.session_id || strftime(x.event_timestamp_date, '_%Y-%m-%d 00:00:00+00_') "
                    "|| x.event_name")
        at = "x.event_timestamp_date"
    return f"""
    SELECT {identity} AS conversion_id, x.event_date_partition AS conversion_date,
      {at} AS conversion_timestamp, x.session_id, x.user_pseudo_id, x.user_id,
      x.event_date_partition AS date_key, {_key_columns(_EVENT_VALUES, conformed)},
      if(x.is_lead_event, 'lead', if(x.is_conversion_event, 'purchase', 'other'))
        AS conversion_type,
      x.event_name, x.lead_id, CAST(x.conversion_value AS DOUBLE) AS conversion_value,
      x.purchase_revenue, x.conversion_number = 1 AS is_first_conversion, x.conversion_number
    FROM {_lookup_joins(f"{source} AS x", _EVENT_VALUES, prefix)}"""


_DIM_DATES = "dd.year, dd.quarter, dd.month, dd.week, dd.day_name"
_SHOWN = """dev.device_category, dev.device_type_group, dev.operating_system,
      g.country, g.region, g.city, g.region_group,
      c.utm_source, c.utm_medium, c.utm_campaign, c.campaign_full_name,
      ch.channel_group, ch.channel_type, ch.source, ch.medium"""


def _star(fact: str, prefix: str) -> str:
    return f"""{fact} AS f LEFT JOIN d_date AS dd USING (date_key)
      LEFT JOIN {prefix}_device AS dev USING (device_key)
      LEFT JOIN {prefix}_geo AS g USING (geo_key)
      LEFT JOIN {prefix}_campaign AS c USING (campaign_key)
      LEFT JOIN {prefix}_channel AS ch USING (channel_key)"""


def _mart_sessions(fact: str, prefix: str) -> str:
    return f"""
    SELECT f.session_id, f.session_date, f.user_pseudo_id, f.user_id, {_DIM_DATES},
      dd.is_weekend, {_SHOWN}, f.session_start_timestamp, f.session_end_timestamp,
      f.session_duration_seconds, f.events_count, f.pageviews, f.has_conversion, f.has_lead,
      f.session_engaged, f.total_conversion_value, f.total_purchase_revenue, f.landing_page,
      f.exit_page, CAST(coalesce(f.has_conversion, false) AS BIGINT) AS conversions,
      CAST(coalesce(f.has_lead, false) AS BIGINT) AS leads,
      CAST(coalesce(f.session_engaged > 0, false) AS BIGINT) AS engaged_sessions
    FROM {_star(fact, prefix)}"""


def _mart_conversions(fact: str, prefix: str) -> str:
    return f"""
    SELECT f.conversion_id, f.conversion_date, f.conversion_timestamp, f.session_id,
      f.user_pseudo_id, f.user_id, {_DIM_DATES}, {_SHOWN}, f.conversion_type, f.event_name,
      f.lead_id, f.conversion_value, f.purchase_revenue, f.is_first_conversion,
      f.conversion_number, CAST(f.conversion_type = 'lead' AS BIGINT) AS leads,
      CAST(f.conversion_type = 'purchase' AS BIGINT) AS purchases
    FROM {_star(fact, prefix)} LEFT JOIN {prefix}_event AS et USING (event_type_key)"""


_DEVICE_EXTRA = f"{_table_case('device_category', V.DEVICE_TYPES)} AS device_type_group"
_GEO_EXTRA = f"{_table_case('country', V.REGION_GROUPS)} AS region_group"
_CAMPAIGN_EXTRA = "concat_ws(' / ', utm_source, utm_medium, utm_campaign) AS campaign_full_name"
_CHANNEL_EXTRA = (f"{_channel_case()} AS channel_group, "
                  f"{_table_case('medium', V.CHANNEL_TYPES)} AS channel_type")
_EVENT_EXTRA = (f"{_table_case('event_name', V.EVENT_CATEGORIES)} AS event_category, "
                f"event_name IN {_in(V.CONVERSION_EVENTS)} AS is_conversion_event, "
                f"event_name IN {_in(V.LEAD_EVENTS)} AS is_lead_event")
_UTMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")


def _unknown_row(*columns: str) -> str:
    return "SELECT " + ", ".join(f"'unknown' AS {c}" for c in columns)


def _log_rows(table: str, layer: str, date: str, metrics: dict[str, str]) -> str:
    out = []
    for name, expr in metrics.items():
        rule = "> 0" if name.endswith("volume") else "= 0"
        out.append(f"SELECT {date} AS check_date, '{layer}' AS layer, '{name}' AS "
                   f"assertion_name, if({expr} {rule}, 'PASS', 'FAIL') AS status, "
                   f"CAST({expr} AS BIGINT) AS count FROM {table}")
    return " UNION ALL ".join(out)


def _dq(event_src: str, sess_src: str, fact_src: str, dates: tuple[str, str, str],
        groups: tuple[str, str, str]) -> str:
    return " UNION ALL ".join([
        _log_rows(f"{event_src} {groups[0]}", "stage", dates[0], {
            "events_volume": "count(*)",
            "events_without_session": "count(*) FILTER (ga_session_id IS NULL)"}),
        _log_rows(f"{sess_src} {groups[1]}", "stage", dates[1], {
            "sessions_volume": "count(*)",
            "negative_session_duration": "count(*) FILTER (session_duration_seconds < 0)"}),
        _log_rows(f"{fact_src} {groups[2]}", "olap", dates[2], {
            "fact_sessions_volume": "count(*)",
            "dim_date_integrity":
                "count(*) FILTER (date_key IS NULL OR date_key NOT IN (FROM date_keys))",
            "dim_device_integrity":
                "count(*) FILTER (device_key IS NULL OR device_key NOT IN (FROM device_keys))"}),
    ])


def _bytes(columns: dict[str, str]) -> str:
    parts = []
    for name, kind in columns.items():
        width = {"text": f"strlen({name}) + 2", "flag": "1", "num": "8"}[kind]
        parts.append(f"CASE WHEN {name} IS NULL THEN 0 ELSE {width} END")
    return " + ".join(parts)


_NUMERIC_FLAT = {"event_timestamp_date", "event_date_partition", "event_timestamp",
                 "ga_session_id", "session_engaged", "total_item_quantity", "purchase_revenue",
                 "src_event_id"}
_FLAGS = {"is_conversion_event", "is_lead_event", "has_conversion", "has_lead"}
_TEXT_SESSION = {"session_id", "user_pseudo_id", "user_id", "landing_page", "exit_page",
                 "device_category", "device_os", "country", "region", "city", "source",
                 "medium", "campaign", "term", "content"}
SESSION_COLUMNS = [
    *stage.SESSION_GRAIN, "session_start_timestamp", "session_end_timestamp",
    "session_duration_seconds", "events_count", "unique_events_count", "pageviews", "scrolls",
    "has_conversion", "has_lead", "conversion_events_count", "lead_events_count",
    "total_conversion_value", "max_purchase_revenue", "total_purchase_revenue", "landing_page",
    "exit_page", "device_category", "device_os", "country", "region", "city", "source", "medium",
    "campaign", "term", "content", "session_engaged"]
_FLAT_KINDS = {c: "flag" if c in _FLAGS else "num" if c in _NUMERIC_FLAT else "text"
               for c in stage.FLAT_COLUMNS}
_SESSION_KINDS = {c: "flag" if c in _FLAGS else "text" if c in _TEXT_SESSION else "num"
                  for c in SESSION_COLUMNS}

CTES: dict[str, str] = {
    "ev": """SELECT event_id AS e, user_id AS u, event_type AS kind, value AS v, ts,
      epoch_us(ts) AS us, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "named": """SELECT *, CASE kind
        WHEN 'view' THEN if(e % 3 = 0, 'scroll', 'page_view')
        WHEN 'click' THEN if(e % 4 = 0, 'file_download', if(e % 4 = 1, 'search', 'click'))
        WHEN 'purchase' THEN if(e % 5 = 0, 'add_to_cart', if(e % 5 = 1, 'conversion', 'purchase'))
        WHEN 'signup' THEN if(e % 3 = 0, 'generate_lead', if(e % 3 = 1, 'form_submit', 'contact'))
        ELSE 'exception' END AS event_name,
      if(e % 97 = 0, NULL, us // 43200000000 * 43200) AS ga,
      if(e % 11 = 0, NULL, if(e % 13 = 0, 'app://home',
        'https://' || ['www.a.com', 'shop.a.com', 'b.org'][k % 3 + 1] || '/p' || k % 20)) AS loc
      FROM ev""",
    "flat": f"""SELECT strftime(ts, '%Y%m%d') AS event_date,
      date_trunc('day', ts) AS event_timestamp_date, CAST(ts AS DATE) AS event_date_partition,
      us AS event_timestamp, event_name, 'u' || u AS user_pseudo_id,
      if(u % 3 = 0, 'c' || u, NULL) AS user_id, ga AS ga_session_id, loc AS page_location,
      'Page ' || k % 20 AS page_title,
      if(k % 5 = 0, 'https://ref.example/', NULL) AS page_referrer,
      if(k < 60, ['google', 'bing', 'facebook', 'newsletter', 'partner', 'twitter'][k % 6 + 1],
         NULL) AS utm_source,
      if(k < 60, ['cpc', 'organic', 'social', 'email', 'referral', 'display'][k % 7 + 1], NULL)
        AS utm_medium,
      if(k < 60 AND k % 10 <> 0, 'c' || k % 5, NULL) AS utm_campaign,
      if(k < 60 AND k % 3 = 0, 't' || k % 2, NULL) AS utm_term,
      if(k < 60 AND k % 4 = 0, 'banner', NULL) AS utm_content,
      if(event_name IN {_in(V.LEAD_EVENTS)}, 'L' || e, NULL) AS lead_id,
      if(kind = 'purchase', CAST(v AS VARCHAR), NULL) AS conversion_value,
      ['desktop', 'mobile', 'tablet', 'smart tv'][u % 5 + 1] AS device_category,
      ['Apple', 'Samsung'][e % 3 + 1] AS device_mobile_brand,
      ['m1', 'm2'][e % 3 + 1] AS device_mobile_model,
      ['Windows', 'Android', 'iOS'][u % 4 + 1] AS device_os,
      ['10', '11'][e % 2 + 1] AS device_os_version,
      ['United States', 'Canada', 'Brazil', 'Argentina', 'Spain', 'France', 'Japan', 'India',
       'Kenya'][u % 10 + 1] AS country,
      'r' || u % 3 AS region, ['A', 'B'][u % 3 + 1] AS city,
      ['Americas', 'Americas', 'Americas', 'Americas', 'Europe', 'Europe', 'Asia', 'Asia',
       'Africa'][u % 10 + 1] AS continent,
      ['(organic)', '(direct)', 'brand'][u % 4 + 1] AS traffic_source_name,
      ['organic', '(none)', 'cpc'][u % 4 + 1] AS traffic_source_medium,
      ['google', '(direct)', 'bing'][u % 4 + 1] AS traffic_source_source,
      e % 2 AS session_engaged, if(event_name = 'purchase', k % 4 + 1, NULL)
        AS total_item_quantity,
      if(event_name = 'purchase', v, NULL) AS purchase_revenue,
      if(event_name = 'purchase', 'USD', NULL) AS purchase_revenue_currency,
      strftime(ts, '%Y%m%d') AS table_suffix, 'u' || u || '_' || ga AS session_id,
      if(loc LIKE 'http%', split_part(loc, '/', 3), NULL) AS page_domain,
      event_name IN {_in(V.CONVERSION_EVENTS)} AS is_conversion_event,
      event_name IN {_in(V.LEAD_EVENTS)} AS is_lead_event, e AS src_event_id FROM named""",
    "sess": _sessions("session_id, user_pseudo_id, user_id, ga_session_id, "
                      "event_date_partition AS session_date",
                      "GROUP BY ALL", "event_timestamp_date"),
    "sess_event": _sessions("session_id, user_pseudo_id, user_id, ga_session_id, "
                            "event_date_partition AS session_date",
                            "GROUP BY ALL", "make_timestamp(event_timestamp)"),
    "sess_real": _sessions(
        "session_id, user_pseudo_id, ga_session_id, "
        f"first(user_id ORDER BY {EVENT_ORDER}) FILTER (user_id IS NOT NULL) AS user_id, "
        "CAST(min(make_timestamp(event_timestamp)) AS DATE) AS session_date",
        "WHERE session_id IS NOT NULL GROUP BY session_id, user_pseudo_id, ga_session_id",
        "make_timestamp(event_timestamp)"),
    "usr": f"""SELECT user_pseudo_id, user_id, min(session_date) AS user_first_seen_date,
      max(session_date) AS user_last_seen_date,
      max(session_date) - min(session_date) AS user_lifetime_days,
      count(DISTINCT session_id) AS total_sessions,
      CAST(sum(events_count) AS BIGINT) AS total_events,
      CAST(sum(pageviews) AS BIGINT) AS total_pageviews,
      count(*) FILTER (has_conversion) AS total_conversions,
      count(*) FILTER (has_lead) AS total_leads,
      round(sum(total_conversion_value), 4) AS total_user_conversion_value,
      round(sum(total_purchase_revenue), 4) AS total_user_purchase_revenue,
      round(avg(session_duration_seconds), 4) AS avg_session_duration_seconds,
      CAST(sum(session_engaged) AS BIGINT) AS total_engaged_sessions,
      {_firsts(stage.USER_PICKS, "session_date, ga_session_id NULLS FIRST, session_id")}
      FROM sess WHERE session_date >= {back(90)} GROUP BY user_pseudo_id, user_id""",
    "device_set": """SELECT DISTINCT coalesce(device_category, 'unknown') AS device_category,
      coalesce(device_mobile_brand, 'unknown') AS mobile_brand,
      coalesce(device_mobile_model, 'unknown') AS mobile_model,
      coalesce(device_os, 'unknown') AS operating_system,
      coalesce(device_os_version, 'unknown') AS operating_system_version
      FROM flat WHERE device_category IS NOT NULL""",
    "geo_set": f"""SELECT DISTINCT {_known("continent", "country", "region", "city")}
      FROM flat WHERE country IS NOT NULL""",
    "campaign_set": f"""SELECT DISTINCT {_known(*_UTMS)} FROM flat
      WHERE coalesce(utm_source, utm_medium, utm_campaign) IS NOT NULL""",
    "channel_set": f"""SELECT DISTINCT {_known("source", "medium")} FROM sess
      WHERE coalesce(source, medium) IS NOT NULL""",
    "event_set": "SELECT DISTINCT event_name FROM flat WHERE event_name IS NOT NULL",
    "d_device": f"""SELECT {_key("device_category", "operating_system", "mobile_brand")}
      AS device_key, *, {_DEVICE_EXTRA} FROM device_set""",
    "d_geo": f"""SELECT {_key("country", "region", "city")} AS geo_key, *, {_GEO_EXTRA}
      FROM geo_set""",
    "d_campaign": f"""SELECT {_key(*_UTMS)} AS campaign_key, *, {_CAMPAIGN_EXTRA}
      FROM (FROM campaign_set UNION {_unknown_row(*_UTMS)})""",
    "d_channel": f"""SELECT {_key("source", "medium", "channel_group")} AS channel_key, *
      FROM (SELECT *, {_CHANNEL_EXTRA} FROM channel_set)""",
    "d_event": f"SELECT sha256(event_name) AS event_type_key, *, {_EVENT_EXTRA} FROM event_set",
    "c_device": f"""SELECT {_key("device_category", "operating_system")} AS device_key, *,
      {_DEVICE_EXTRA} FROM (SELECT DISTINCT ON (device_category, operating_system) *
      FROM (FROM device_set UNION ALL BY NAME {_unknown_row("device_category", "mobile_brand",
      "mobile_model", "operating_system", "operating_system_version")})
      ORDER BY device_category, operating_system, mobile_brand, mobile_model,
      operating_system_version)""",
    "c_geo": f"""SELECT {_key("country", "region", "city")} AS geo_key, *, {_GEO_EXTRA}
      FROM (SELECT min(continent) AS continent, country, region, city
      FROM (FROM geo_set UNION ALL BY NAME {_unknown_row("continent", "country", "region",
      "city")}) GROUP BY country, region, city)""",
    "c_campaign": f"""SELECT {_key(*_UTMS[:3])} AS campaign_key, *, {_CAMPAIGN_EXTRA}
      FROM (SELECT DISTINCT ON (utm_source, utm_medium, utm_campaign) *
      FROM (FROM campaign_set UNION ALL BY NAME {_unknown_row(*_UTMS)})
      ORDER BY utm_source, utm_medium, utm_campaign, utm_term, utm_content)""",
    "c_channel": f"""SELECT {_key("source", "medium", "channel_group")} AS channel_key, *
      FROM (SELECT *, {_CHANNEL_EXTRA} FROM (FROM channel_set UNION
      {_unknown_row("source", "medium")}))""",
    "c_event": f"""SELECT sha256(event_name) AS event_type_key, *, {_EVENT_EXTRA}
      FROM (FROM event_set UNION {_unknown_row("event_name")})""",
    "d_date": f"""SELECT d AS date_key, d AS date_full, year(d) AS year, isoyear(d) AS iso_year,
      quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_name,
      year(d) || '-Q' || quarter(d) AS year_quarter, month(d) AS month,
      monthname(d) AS month_name, strftime(d, '%b') AS month_name_short,
      strftime(d, '%Y-%m') AS year_month, CAST(strftime(d, '%U') AS BIGINT) AS week,
      weekofyear(d) AS iso_week, d - CAST(dayofweek(d) AS INTEGER) AS week_start_date,
      d - CAST(isodow(d) - 1 AS INTEGER) AS week_start_date_monday, day(d) AS day,
      dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name,
      strftime(d, '%a') AS day_name_short, dayofyear(d) AS day_of_year,
      isodow(d) > 5 AS is_weekend, strftime(d, '%Y-%m-%d') IN {_in(V.HOLIDAYS)} AS is_holiday
      FROM (SELECT CAST(unnest(generate_series({_day(V.CALENDAR_START)},
      {_day(V.CALENDAR_END)}, INTERVAL 1 DAY)) AS DATE) AS d)""",
    "conv": """SELECT *, row_number() OVER (PARTITION BY event_date_partition, user_pseudo_id
      ORDER BY event_timestamp, src_event_id) AS conversion_number,
      row_number() OVER (PARTITION BY user_pseudo_id
      ORDER BY event_timestamp, src_event_id) AS lifetime_number
      FROM flat WHERE is_conversion_event OR is_lead_event""",
    "f_sessions": _fact_sessions("d", False),
    "f_events": _fact_events("d", False),
    "f_conversions": _fact_conversions("d", False),
    "g_sessions": _fact_sessions("c", True),
    "g_events": _fact_events("c", True),
    "g_conversions": _fact_conversions("c", True),
    "m_sessions": _mart_sessions("f_sessions", "d"),
    "m_conversions": _mart_conversions("f_conversions", "d"),
    "mart": _mart_sessions("g_sessions", "c"),
    "mart_conv": _mart_conversions("g_conversions", "c"),
    "rlog": """SELECT 'r' || e AS run_id, CAST(ts AS DATE) AS run_date,
      ['daily_load', 'data_quality_checks', 'audit_monitoring'][e % 3 + 1] AS dag_id,
      't' || e % 7 AS task_id, CASE kind WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running'
      ELSE 'success' END AS status, e % 1000 AS rows_processed,
      CAST(round(v * 100) AS BIGINT) * 1000000 AS bytes_processed, u AS duration_seconds,
      if(kind = 'error', 'E' || k % 5, NULL) AS error_message, ts AS run_timestamp FROM ev""",
    "qlog": """SELECT 'j' || e AS job_id, ts AS creation_time,
      if(kind = 'signup', 'INSERT', 'SELECT') AS statement_type,
      CAST(round(v * 100) AS BIGINT) * 45000000 * (e % 10 + 1) // 10 AS total_bytes_processed,
      CAST(round(v * 100) AS BIGINT) * 45000000 AS total_bytes_billed, e * 10 AS total_slot_ms,
      'SELECT * FROM stg_events_flat WHERE event_date_partition = '''
        || strftime(ts, '%Y-%m-%d') || '''' AS query FROM ev""",
    "pstats": f"""SELECT 'stg_events_flat' AS table_name,
      strftime(event_date_partition, '%Y-%m-%d') AS partition_id, count(*) AS total_rows,
      CAST(sum({_bytes(_FLAT_KINDS)}) AS BIGINT) AS total_logical_bytes
      FROM flat GROUP BY ALL UNION ALL SELECT 'stg_sessions',
      strftime(session_date, '%Y-%m-%d'), count(*),
      CAST(sum({_bytes(_SESSION_KINDS)}) AS BIGINT) FROM sess GROUP BY ALL""",
    "date_keys": "SELECT date_key FROM d_date",
    "device_keys": "SELECT device_key FROM c_device",
    "geo_keys": "SELECT geo_key FROM c_geo",
    "channel_keys": "SELECT channel_key FROM c_channel",
    "dq_history": _dq("flat", "sess", "g_sessions",
                      ("event_date_partition", "session_date", "session_date"),
                      ("GROUP BY event_date_partition", "GROUP BY session_date",
                       "GROUP BY session_date")),
    "dq_day": _dq("flat", "sess", "g_sessions", (RUN, RUN, RUN),
                  (f"WHERE event_date_partition = {RUN}", f"WHERE session_date = {RUN}",
                   f"WHERE session_date = {RUN}")),
    "vol": "SELECT event_date_partition AS date, count(*) AS events_count FROM flat GROUP BY 1",
}


def with_ctes(sql: str) -> str:
    """The query preceded by the CTEs it mentions, in order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    chain = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed)
    return f"WITH {chain}\n{sql}" if chain else sql
