"""Keys: session keys, hashed surrogate keys, event and conversion ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickstar import fixed_values as V


def known(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value, F.lit(V.UNKNOWN))


def surrogate_key(*parts: Column | str) -> Column:
    """Lower-case hex SHA-256 of the parts; a missing part counts as 'unknown'."""
    return F.sha2(F.concat_ws(V.KEY_SEPARATOR, *[known(p) for p in parts]), 256)


def unknown_key(parts: int) -> Column:
    return surrogate_key(*[F.lit(V.UNKNOWN)] * parts)


def session_key(user: Column, session: Column) -> Column:
    """NULL as soon as either part is NULL."""
    return F.concat(user, F.lit("_"), session.cast("string"))


def utc_text(ts: Column) -> Column:
    """A timestamp as text with its UTC offset, e.g. 2024-01-15 00:00:00+00."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))


def event_id(session: Column, micros: Column, name: Column) -> Column:
    return F.concat(session, F.lit("_"), micros.cast("string"), F.lit("_"), name)


def conversion_id(session: Column, ts: Column, name: Column) -> Column:
    return F.concat(session, F.lit("_"), utc_text(ts), F.lit("_"), name)


def row_identity(user: Column, session: Column, micros: Column, name: Column,
                 sequence: Column) -> Column:
    """An id that is never NULL and unique per source event.

    Events without a session keep their user; ``sequence`` separates events of
    one name in one microsecond.
    """
    owner = F.coalesce(session, F.concat(known(user), F.lit("_")))
    return F.concat_ws("_", owner, micros.cast("string"), known(name), sequence.cast("string"))
