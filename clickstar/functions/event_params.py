"""Reading keyed event parameters out of the nested array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_param(key: str, field: str, params: str = "event_params") -> Column:
    """Value field of the first parameter called ``key``; NULL when absent.

    ``array_position`` and ``get`` stay inside generated code, which a lambda over
    the array does not.
    """
    at = f"CAST(array_position({params}.key, '{key}') AS INT) - 1"
    return F.expr(f"get({params}.value, {at}).{field}")


def event_param_typed(key: str, kind: str, params: str = "event_params") -> Column:
    """A parameter as text, taken from the field its declared kind is kept in."""
    field = {"int": "int_value", "double": "double_value"}.get(kind, "string_value")
    return event_param(key, field, params).cast("string")


def has_duplicate_keys(params: str = "event_params") -> Column:
    return F.expr(f"size(array_distinct({params}.key)) < size({params})")
