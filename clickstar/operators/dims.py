"""Dimensions.

``members`` gives every distinct attribute combination. It can hold several rows
per lookup key (one device category and system, many models), so a join on the
lookup columns repeats fact rows. ``conformed`` keeps one row per lookup key and
adds an unknown member; the load job uses that form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar.functions import calendar as cal
from clickstar.functions import keys, rules
from clickstar.sources.calendar import generate_dates


@dataclass(frozen=True)
class Dimension:
    """Where a dimension's columns come from and which of them identify a row."""

    name: str
    key: str
    columns: dict[str, str]
    key_parts: tuple[str, ...]
    lookup: tuple[str, ...]
    needed: tuple[str, ...]

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.columns if c not in self.lookup]

    def derived(self) -> dict[str, Column]:
        """Columns that follow from the others."""
        if self.name == "dim_device":
            return {"device_type_group": rules.device_type(F.col("device_category"))}
        if self.name == "dim_geo":
            return {"region_group": rules.region_group(F.col("country"))}
        if self.name == "dim_campaign":
            return {"campaign_full_name": F.concat_ws(" / ", "utm_source", "utm_medium",
                                                      "utm_campaign")}
        if self.name == "dim_channel":
            source, medium = F.col("source"), F.col("medium")
            return {"channel_group": rules.channel_group(source, medium),
                    "channel_type": rules.channel_type(medium)}
        name = F.col("event_name")
        return {"event_category": rules.event_category(name),
                "is_conversion_event": rules.is_conversion(name),
                "is_lead_event": rules.is_lead(name)}


DEVICE = Dimension(
    "dim_device", "device_key",
    {"device_category": "device_category", "mobile_brand": "device_mobile_brand",
     "mobile_model": "device_mobile_model", "operating_system": "device_os",
     "operating_system_version": "device_os_version"},
    ("device_category", "operating_system", "mobile_brand"),
    ("device_category", "operating_system"), ("device_category",))

GEO = Dimension(
    "dim_geo", "geo_key",
    {"continent": "continent", "country": "country", "region": "region", "city": "city"},
    ("country", "region", "city"), ("country", "region", "city"), ("country",))

CAMPAIGN = Dimension(
    "dim_campaign", "campaign_key",
    {c: c for c in ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")},
    ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content"),
    ("utm_source", "utm_medium", "utm_campaign"),
    ("utm_source", "utm_medium", "utm_campaign"))

CHANNEL = Dimension(
    "dim_channel", "channel_key", {"source": "source", "medium": "medium"},
    ("source", "medium", "channel_group"), ("source", "medium"), ("source", "medium"))

EVENT_TYPE = Dimension(
    "dim_event_type", "event_type_key", {"event_name": "event_name"},
    ("event_name",), ("event_name",), ("event_name",))

DIMENSIONS = {d.name: d for d in (DEVICE, GEO, CAMPAIGN, CHANNEL, EVENT_TYPE)}


def any_known(*columns: str) -> Column:
    cond = F.col(columns[0]).isNotNull()
    for column in columns[1:]:
        cond = cond | F.col(column).isNotNull()
    return cond


def combinations(rows: DataFrame, dim: Dimension) -> DataFrame:
    """Distinct attribute combinations; the only step that shuffles, after a local distinct."""
    return (rows.where(any_known(*dim.needed))
            .select(*[keys.known(source).alias(name) for name, source in dim.columns.items()])
            .distinct())


def with_key(rows: DataFrame, dim: Dimension, parts: tuple[str, ...]) -> DataFrame:
    """Derived columns and the hashed key, computed on distinct rows only."""
    full = rows.withColumns(dim.derived())
    return full.select(keys.surrogate_key(*parts).alias(dim.key),
                       *[c for c in full.columns if c != dim.key])


def members(rows: DataFrame, dim: Dimension) -> DataFrame:
    """The dimension with one row per attribute combination."""
    out = with_key(combinations(rows, dim), dim, dim.key_parts)
    if dim is CAMPAIGN:
        out = insert_if_absent(out, unknown_member(out, dim, dim.key_parts), dim.key)
    return out


def unknown_member(like: DataFrame, dim: Dimension, parts: tuple[str, ...]) -> DataFrame:
    """The row that facts without a match point to."""
    return with_key(unknown_combination(like.sparkSession, dim), dim, parts)


def unknown_combination(spark: SparkSession, dim: Dimension) -> DataFrame:
    return spark.range(1).select(*[F.lit(V.UNKNOWN).alias(c) for c in dim.columns])


def insert_if_absent(target: DataFrame, defaults: DataFrame, key: str) -> DataFrame:
    """Adds the default rows whose key the target does not hold."""
    return target.unionByName(defaults.join(target.select(key), key, "left_anti"))


def collapse(rows: DataFrame, dim: Dimension) -> DataFrame:
    """One row per lookup key, attributes from the smallest combination."""
    if not dim.attributes:
        return rows.distinct()
    return (rows.groupBy(*dim.lookup).agg(F.min(F.struct(*dim.attributes)).alias("_a"))
            .select(*dim.lookup, *[F.col(f"_a.{c}").alias(c) for c in dim.attributes])
            .select(*dim.columns))


def conformed_parts(dim: Dimension) -> tuple[str, ...]:
    """Parts of the conformed key: they never change when attributes do."""
    return dim.key_parts if dim is CHANNEL else dim.lookup


def conformed(rows: DataFrame, dim: Dimension) -> DataFrame:
    """One row per lookup key, the unknown member among them."""
    both = combinations(rows, dim).unionByName(unknown_combination(rows.sparkSession, dim))
    return with_key(collapse(both, dim), dim, conformed_parts(dim))


def extend(existing: DataFrame, rows: DataFrame, dim: Dimension) -> DataFrame:
    """A conformed dimension after the day's rows; equal to a rebuild over all days.

    The smallest combination of old and new rows is the smallest overall, so a
    daily load reads one day instead of the whole history.
    """
    new = combinations(rows, dim)
    both = existing.select(*dim.columns).unionByName(new)
    return with_key(collapse(both, dim), dim, conformed_parts(dim))


def unknown_key(dim: Dimension) -> Column:
    """Key of the unknown member."""
    if dim is CHANNEL:
        return keys.surrogate_key(F.lit(V.UNKNOWN), F.lit(V.UNKNOWN), F.lit(V.OTHER))
    return keys.unknown_key(len(conformed_parts(dim)))


def dim_date(spark: SparkSession) -> DataFrame:
    """The calendar: 4,018 days, a fixed size."""
    d = F.col("date_value")
    return generate_dates(spark).select(
        d.alias("date_key"), d.alias("date_full"),
        F.year(d).cast("bigint").alias("year"), cal.iso_year(d).cast("bigint").alias("iso_year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("year_quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        cal.sunday_week(d).alias("week"), F.weekofyear(d).cast("bigint").alias("iso_week"),
        cal.sunday_week_start(d).alias("week_start_date"),
        cal.monday_week_start(d).alias("week_start_date_monday"),
        F.day(d).cast("bigint").alias("day"), F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        d.isin([F.lit(h).cast("date") for h in V.HOLIDAYS]).alias("is_holiday"))
