"""Stage layer: flat events, sessions and users.

Flattening is a projection and never shuffles. Sessions and users are grouped
with partial aggregation before the shuffle, so a session or user that holds a
large share of all rows reaches the shuffle as one row per input task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar.functions import keys, rules
from clickstar.functions.event_params import event_param

FLAT_COLUMNS = [
    "event_date", "event_timestamp_date", "event_date_partition", "event_timestamp",
    "event_name", "user_pseudo_id", "user_id", "ga_session_id", "page_location", "page_title",
    "page_referrer", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "lead_id", "conversion_value", "device_category", "device_mobile_brand",
    "device_mobile_model", "device_os", "device_os_version", "country", "region", "city",
    "continent", "traffic_source_name", "traffic_source_medium", "traffic_source_source",
    "session_engaged", "total_item_quantity", "purchase_revenue", "purchase_revenue_currency",
    "table_suffix", "session_id", "page_domain", "is_conversion_event", "is_lead_event",
    "src_event_id",
]

FLAT_LITE_COLUMNS = [
    "event_date", "event_timestamp_date", "event_timestamp", "event_name", "user_pseudo_id",
    "user_id", "ga_session_id", "page_location", "page_title", "utm_source", "utm_medium",
    "utm_campaign", "device_category", "device_os", "country", "region", "city",
    "traffic_source_source", "traffic_source_medium", "session_id", "is_conversion_event",
    "is_lead_event",
]

SESSION_GRAIN = ["session_id", "user_pseudo_id", "user_id", "ga_session_id", "session_date"]

# Taken from the first event of a session.
ENTRY_COLUMNS = ["page_location", "device_category", "device_os", "country", "region", "city",
                 "utm_source", "traffic_source_source", "utm_medium", "traffic_source_medium",
                 "utm_campaign", "utm_term", "utm_content"]


def parse_event_date(text: Column) -> Column:
    return F.to_date(text, "yyyyMMdd")


def tie_breaker() -> Column:
    """What tells events of one name and microsecond apart.

    The source's own sequence where it has one, else a hash of the whole event, so that
    an export without a sequence still loads to the same rows on every run.
    """
    content = [F.col(c) for c in ("event_timestamp", "event_name", "user_pseudo_id", "user_id",
                                  "event_params", "device", "geo", "traffic_source", "ecommerce")]
    return F.coalesce(F.col("src_event_id"), F.xxhash64(*content))


def flatten(raw: DataFrame) -> DataFrame:
    """Flat events: parameters and nested fields as columns, plus derived ones."""
    day = parse_event_date(F.col("event_date"))
    nested = {
        "device_category": "device.category",
        "device_mobile_brand": "device.mobile_brand_name",
        "device_mobile_model": "device.mobile_model_name",
        "device_os": "device.operating_system",
        "device_os_version": "device.operating_system_version",
        "country": "geo.country", "region": "geo.region", "city": "geo.city",
        "continent": "geo.continent",
        "traffic_source_name": "traffic_source.name",
        "traffic_source_medium": "traffic_source.medium",
        "traffic_source_source": "traffic_source.source",
        "total_item_quantity": "ecommerce.total_item_quantity",
        "purchase_revenue": "ecommerce.purchase_revenue",
        "purchase_revenue_currency": "ecommerce.purchase_revenue_currency",
    }
    opened = raw.select(
        "event_date", day.cast("timestamp").alias("event_timestamp_date"),
        day.alias("event_date_partition"), "event_timestamp", "event_name", "user_pseudo_id",
        "user_id",
        *[event_param(p, "int_value").alias(p) for p in V.INT_PARAMS],
        *[event_param(p, "string_value").alias(p) for p in V.TEXT_PARAMS],
        *[F.col(path).alias(name) for name, path in nested.items()],
        "table_suffix", tie_breaker().alias("src_event_id"))
    return opened.withColumns({
        "session_id": keys.session_key(F.col("user_pseudo_id"), F.col("ga_session_id")),
        "page_domain": rules.page_domain(F.col("page_location")),
        "is_conversion_event": rules.is_conversion(F.col("event_name")),
        "is_lead_event": rules.is_lead(F.col("event_name")),
    }).select(*FLAT_COLUMNS)


def flatten_lite(raw: DataFrame) -> DataFrame:
    """The reduced flat table; unused parameters are never extracted."""
    return flatten(raw).select(*FLAT_LITE_COLUMNS)


def as_amount(text: Column, lenient: bool = False) -> Column:
    """Text to double. Bad text stops the job unless ``lenient``, then it is NULL."""
    return text.try_cast("double") if lenient else text.cast("double")


def event_time(time_col: str) -> Column:
    """Session clock: ``day`` is midnight of the event date, ``event`` the real time."""
    if time_col == "day":
        return F.col("event_timestamp_date")
    return F.timestamp_micros(F.col("event_timestamp"))


def sessions(flat: DataFrame, time_col: str = "day", lenient: bool = False) -> DataFrame:
    """One row per session, user and day.

    Entry attributes come from one ordered struct, so the first event is found
    once for all of them; NULL attributes of that event stay NULL.
    """
    return _sessionise(
        flat.withColumn("session_date", F.col("event_timestamp_date").cast("date")),
        SESSION_GRAIN, time_col, lenient)


def session_parts(time_col: str = "day", lenient: bool = False) -> dict[str, Column]:
    """Aggregates that can be built up event by event, in batch and in a stream."""
    at = event_time(time_col)
    order = [F.col("event_timestamp"), F.col("src_event_id")]
    conversion, lead = F.col("is_conversion_event"), F.col("is_lead_event")
    return {
        "session_start_timestamp": F.min(at),
        "session_end_timestamp": F.max(at),
        "events_count": F.count(F.lit(1)),
        "pageviews": F.count_if(F.col("event_name") == V.PAGE_VIEW_EVENT),
        "scrolls": F.count_if(F.col("event_name") == V.SCROLL_EVENT),
        "has_conversion": F.max(conversion),
        "has_lead": F.max(lead),
        "conversion_events_count": F.count_if(conversion),
        "lead_events_count": F.count_if(lead),
        "total_conversion_value": F.sum(as_amount(F.col("conversion_value"), lenient)),
        "max_purchase_revenue": F.max("purchase_revenue"),
        "total_purchase_revenue": F.sum("purchase_revenue"),
        "session_engaged": F.max("session_engaged"),
        "entry": F.min(F.struct(*order, *ENTRY_COLUMNS)),
        "last": F.max(F.struct(*order, "page_location")),
    }


# How parts of one session that were built apart become one.
COMBINE = {"session_start_timestamp": F.min, "entry": F.min, "events_count": F.sum,
           "pageviews": F.sum, "scrolls": F.sum, "conversion_events_count": F.sum,
           "lead_events_count": F.sum, "total_conversion_value": F.sum,
           "total_purchase_revenue": F.sum}


def combined_parts(parts: DataFrame, grain: list[str]) -> DataFrame:
    """Sessions whose ``session_parts`` were aggregated in several pieces; the rest is a maximum."""
    names = [c for c in parts.columns if c not in grain]
    return parts.groupBy(*grain).agg(*[COMBINE.get(c, F.max)(c).alias(c) for c in names])


def session_columns(grain: list[str], extra: tuple[str, ...] = ()) -> list[Column]:
    """Final session columns from the aggregates of ``session_parts``."""
    return [
        *[F.col(c) for c in grain],
        F.col("session_start_timestamp"), F.col("session_end_timestamp"),
        F.timestamp_diff("SECOND", F.col("session_start_timestamp"),
                         F.col("session_end_timestamp")).alias("session_duration_seconds"),
        F.col("events_count"), *[F.col(c) for c in extra],
        F.col("pageviews"), F.col("scrolls"), F.col("has_conversion"), F.col("has_lead"),
        F.col("conversion_events_count"), F.col("lead_events_count"),
        F.col("total_conversion_value"), F.col("max_purchase_revenue"),
        F.col("total_purchase_revenue"),
        F.col("entry.page_location").alias("landing_page"),
        F.col("last.page_location").alias("exit_page"),
        F.col("entry.device_category").alias("device_category"),
        F.col("entry.device_os").alias("device_os"),
        F.col("entry.country").alias("country"), F.col("entry.region").alias("region"),
        F.col("entry.city").alias("city"),
        F.coalesce("entry.utm_source", "entry.traffic_source_source").alias("source"),
        F.coalesce("entry.utm_medium", "entry.traffic_source_medium").alias("medium"),
        F.col("entry.utm_campaign").alias("campaign"), F.col("entry.utm_term").alias("term"),
        F.col("entry.utm_content").alias("content"), F.col("session_engaged"),
    ]


def distinct_names() -> Column:
    """How many different event names there are.

    As a set beside the other aggregates: a distinct count would shuffle and sort the wide
    rows twice, by session and name and then by session. Names are a vocabulary, so sets are small.
    """
    return F.size(F.collect_set("event_name")).cast("bigint")


def _sessionise(events: DataFrame, grain: list[str], time_col: str, lenient: bool) -> DataFrame:
    parts = {**session_parts(time_col, lenient), "unique_events_count": distinct_names()}
    grouped = events.groupBy(*grain).agg(*[c.alias(n) for n, c in parts.items()])
    return grouped.select(*session_columns(grain, ("unique_events_count",)))


SESSION_LITE_COLUMNS = [
    *SESSION_GRAIN, "session_start_timestamp", "session_end_timestamp",
    "session_duration_seconds", "events_count", "pageviews", "has_conversion", "has_lead",
    "landing_page", "exit_page", "device_category", "country", "region", "source", "medium",
    "campaign",
]


def sessions_lite(flat: DataFrame) -> DataFrame:
    """The reduced session table; the distinct count and its shuffle are not planned."""
    day = flat.withColumn("session_date", F.col("event_timestamp_date").cast("date"))
    parts = session_parts()
    grouped = day.groupBy(*SESSION_GRAIN).agg(*[c.alias(n) for n, c in parts.items()])
    return grouped.select(*session_columns(SESSION_GRAIN)).select(*SESSION_LITE_COLUMNS)


def sessions_conformed(flat: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per session id over real event times.

    A session that crosses midnight or logs in midway stays one row: it takes the
    first known user id and the day it started. Events without a session are left
    out, as they belong to none.
    """
    known = flat.where(F.col("session_id").isNotNull())
    parts = {
        **session_parts("event", lenient),
        "unique_events_count": distinct_names(),
        "login": F.min(F.when(F.col("user_id").isNotNull(),
                              F.struct("event_timestamp", "src_event_id", "user_id"))),
    }
    grouped = (known.groupBy("session_id", "user_pseudo_id", "ga_session_id")
               .agg(*[c.alias(n) for n, c in parts.items()])
               .withColumn("user_id", F.col("login.user_id"))
               .withColumn("session_date", F.to_date("session_start_timestamp")))
    return grouped.select(*session_columns(SESSION_GRAIN, ("unique_events_count",)))


def session_bounds(flat: DataFrame, time_col: str = "day") -> DataFrame:
    """First and last time and whole seconds between them, per session and day."""
    at = event_time(time_col)
    grain = ["session_id", "user_pseudo_id", "user_id", "ga_session_id", "event_date_partition"]
    return (flat.groupBy(*grain).agg(F.min(at).alias("session_start_timestamp"),
                                     F.max(at).alias("session_end_timestamp"))
            .withColumn("session_duration_seconds", F.timestamp_diff(
                "SECOND", F.col("session_start_timestamp"), F.col("session_end_timestamp"))))


def gap_sessions(flat: DataFrame, gap_minutes: int = 30, slot_minutes: int = 60) -> DataFrame:
    """Sessions by inactivity gap: events of a user less than the gap apart belong together.

    Events of a user in one time slot as long as the gap always belong together, so each user
    and slot is first aggregated to one span, in part before the shuffle; a user with very many
    events is spread over many tasks and leaves one row a slot. The spans are then chained.
    Events without a user cannot be told apart by visitor: they count as one span per slot of
    ``slot_minutes``. The input is read once.
    """
    return chained(gap_pieces(flat, gap_minutes, slot_minutes), gap_minutes, slot_minutes)


def gap_pieces(flat: DataFrame, gap_minutes: int = 30, slot_minutes: int = 60) -> DataFrame:
    """One span (user_pseudo_id, first, last, n) per user and slot, as input of :func:`chained`."""
    events = flat.where(F.col("event_timestamp").isNotNull()).select(
        "user_pseudo_id", F.col("event_timestamp").alias("first"),
        F.col("event_timestamp").alias("last"), F.lit(1).cast("bigint").alias("n"))
    slot = F.when(F.col("user_pseudo_id").isNull(), _slot(slot_minutes)).otherwise(_slot(gap_minutes))
    return _spans(events, ["user_pseudo_id", slot.alias("slot")]).drop("slot")


def chained(spans: DataFrame, gap_minutes: int = 30, slot_minutes: int = 60) -> DataFrame:
    """Sessions from spans (user_pseudo_id, first, last, n) that were chained in pieces.

    Spans may overlap, as pieces of different batches do. Unknown visitors are no visitor:
    their spans are not chained across slots, but those of one slot are one span again.
    """
    return combined_spans(spans, gap_minutes, slot_minutes).select(
        "user_pseudo_id", F.timestamp_micros("first").alias("first_event_at"),
        F.timestamp_micros("last").alias("last_event_at"), F.col("n").alias("events_count"))


def combined_spans(spans: DataFrame, gap_minutes: int = 30, slot_minutes: int = 60) -> DataFrame:
    """Spans joined where they start less than the gap after all before have ended.

    Combining may happen in any order and any number of times: joined spans are spans again.
    """
    ordered = Window.partitionBy("user_pseudo_id").orderBy("first", "last")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.when(F.col("user_pseudo_id").isNull(), _slot(slot_minutes) != F.lag(
        _slot(slot_minutes)).over(ordered)).otherwise(
        F.col("first") - F.max("last").over(so_far) >= gap_minutes * 60_000_000)
    marked = spans.select("user_pseudo_id", "first", "last", "n").withColumn(
        "new", F.when(apart, 1).otherwise(0))
    numbered = marked.withColumn("session", F.sum("new").over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return _spans(numbered, ["user_pseudo_id", "session"]).drop("session")


def _slot(minutes: int) -> Column:
    """Number of the time slot a span starts in, also before 1970."""
    micros = minutes * 60_000_000
    return F.expr(f"(first - pmod(first, {micros}L)) div {micros}L")


def _spans(rows: DataFrame, group: list) -> DataFrame:
    return rows.groupBy(*group).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))


USER_PICKS = {"device_category": "primary_device_category", "country": "primary_country",
              "source": "primary_source", "medium": "primary_medium"}


def users(session_rows: DataFrame, most_frequent: bool = False) -> DataFrame:
    """One row per user over the sessions given (the caller applies the look-back).

    Device, country, source and medium come from the first session, or, if
    ``most_frequent``, each is the value that most sessions have (ties: the smallest).
    """
    first = F.min(F.struct("session_date", "ga_session_id", "session_id", *USER_PICKS))
    if most_frequent:
        first = F.struct(*[F.mode(c, True).alias(c) for c in USER_PICKS])
    grouped = session_rows.groupBy("user_pseudo_id", "user_id").agg(
        F.min("session_date").alias("user_first_seen_date"),
        F.max("session_date").alias("user_last_seen_date"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.sum("events_count").alias("total_events"),
        F.sum("pageviews").alias("total_pageviews"),
        F.count_if("has_conversion").alias("total_conversions"),
        F.count_if("has_lead").alias("total_leads"),
        F.sum("total_conversion_value").alias("conversion_value"),
        F.sum("total_purchase_revenue").alias("revenue"),
        F.avg("session_duration_seconds").alias("duration"),
        F.sum("session_engaged").alias("total_engaged_sessions"),
        first.alias("first"))
    return grouped.select(
        "user_pseudo_id", "user_id", "user_first_seen_date", "user_last_seen_date",
        F.datediff("user_last_seen_date", "user_first_seen_date").cast("bigint")
        .alias("user_lifetime_days"),
        "total_sessions", "total_events", "total_pageviews", "total_conversions", "total_leads",
        F.col("conversion_value").alias("total_user_conversion_value"),
        F.col("revenue").alias("total_user_purchase_revenue"),
        F.col("duration").alias("avg_session_duration_seconds"),
        "total_engaged_sessions",
        *[F.col(f"first.{c}").alias(name) for c, name in USER_PICKS.items()])


def users_lite(session_rows: DataFrame) -> DataFrame:
    dropped = ["total_user_conversion_value", "total_user_purchase_revenue",
               "total_engaged_sessions", "primary_source", "primary_medium"]
    return users(session_rows).drop(*dropped)
