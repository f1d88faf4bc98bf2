"""Hand-made raw events."""

from __future__ import annotations

import datetime as dt

from clickstar.schemas import RAW_EVENTS
from clickstar.sources.raw import with_suffix

DAY = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)


def micros(hour: float = 0, day: int = 15, plus: int = 0) -> int:
    start = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)
    return int(start.timestamp() * 1_000_000) + int(hour * 3_600_000_000) + plus


def param(key, text=None, whole=None, double=None):
    return (key, (text, whole, None, double))


def event(at=None, name="page_view", user="u1", user_id=None, seq=0, params=(), device=None,
          geo=None, traffic=None, shop=None, session=1, day=15):
    at = micros(12, day) if at is None else at
    given = list(params)
    if session is not None:
        given.insert(0, param("ga_session_id", whole=session))
    return (at, name, user, user_id, seq, given, device or (None,) * 5, geo or (None,) * 4,
            traffic or (None,) * 3, shop or (None,) * 3, f"202401{day:02d}")


def raw(spark, *events):
    return with_suffix(spark.createDataFrame(list(events), RAW_EVENTS))
