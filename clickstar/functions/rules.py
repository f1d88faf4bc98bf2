"""Classification rules as Column expressions over the fixed rule tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickstar import fixed_values as V


def first_match(rules: list[tuple[str, Column]], default: str) -> Column:
    """Label of the first rule that holds; a NULL condition does not hold."""
    (label, cond), *rest = rules
    start = F.when(cond, F.lit(label))
    return reduce(lambda acc, r: acc.when(r[1], F.lit(r[0])), rest, start).otherwise(F.lit(default))


def by_list(value: Column, table: list[tuple[str, list[str]]]) -> Column:
    return first_match([(label, value.isin(names)) for label, names in table], V.OTHER)


def channel_group(source: Column, medium: Column) -> Column:
    def condition(spec: dict) -> Column:
        parts = []
        if "source" in spec:
            parts.append(source.isin(spec["source"]))
        if "medium" in spec:
            parts.append(medium.isin(spec["medium"]))
        if "medium_contains" in spec:
            parts.append(medium.contains(spec["medium_contains"]))
        return reduce(lambda a, b: a & b, parts)

    return first_match([(label, condition(spec)) for label, spec in V.CHANNEL_GROUPS], V.OTHER)


def channel_type(medium: Column) -> Column:
    return by_list(medium, V.CHANNEL_TYPES)


def event_category(event_name: Column) -> Column:
    return by_list(event_name, V.EVENT_CATEGORIES)


def device_type(category: Column) -> Column:
    return by_list(category, V.DEVICE_TYPES)


def region_group(country: Column) -> Column:
    return by_list(country, V.REGION_GROUPS)


def in_list(value: Column, names: list[str]) -> Column:
    """Membership as a flag that is never NULL."""
    return F.coalesce(value.isin(names), F.lit(False))


def is_conversion(event_name: Column) -> Column:
    return in_list(event_name, V.CONVERSION_EVENTS)


def is_lead(event_name: Column) -> Column:
    return in_list(event_name, V.LEAD_EVENTS)


def page_domain(location: Column) -> Column:
    """Host of a web address, NULL when the address has none."""
    return F.nullif(F.regexp_extract(location, V.PAGE_DOMAIN_PATTERN, 1), F.lit(""))
