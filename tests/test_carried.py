"""Tables that are carried from day to day: users over a window, lifetime numbers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickstar.operators import lifetime, rolling, stage
from tests.rows import micros

SESSIONS = ("session_id string, user_pseudo_id string, user_id string, ga_session_id bigint, "
            "session_date date, device_category string, country string, source string, medium string, "
            "events_count bigint, pageviews bigint, has_conversion boolean, has_lead boolean, "
            "total_conversion_value double, total_purchase_revenue double, "
            "session_duration_seconds bigint, session_engaged bigint")
START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def random_sessions(seed, days, n):
    """Some sessions run over one or two midnights; some have no id, user or value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user, first = f"u{rng.randrange(12)}", rng.randrange(days)
        user = rng.choice([user, user, user, None])
        session = rng.choice([f"{user}_{i}", f"{user}_{i}", None])
        for d in range(first, min(days, first + rng.choice([1, 1, 1, 2, 3]))):
            rows.append((session, user, rng.choice([None, "c"]) if session is None else None, i, day(d),
                         rng.choice(["mobile", None]), "x", "s", "m", rng.randrange(9), 1,
                         rng.random() < 0.4, rng.random() < 0.3, rng.choice([None, 1.5]), None,
                         rng.choice([None, 30]), rng.randrange(2)))
    return rows


def plain(df):
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    rounded = df.withColumns({c: F.round(c, 6) for c in doubles})
    return sorted(map(repr, rounded.select(sorted(df.columns)).collect()))


def window(sessions, first, last):
    return sessions.where(F.col("session_date").between(F.lit(first), F.lit(last)))


@pytest.mark.parametrize("length", [3, 20])
def test_rolled_users_equal_a_rebuild_every_day(spark, tmp_path, length):
    rows, path = random_sessions(length, 26, 160), str(tmp_path / "parts")
    sessions = spark.createDataFrame(rows, SESSIONS)
    rolling.build(spark, path, sessions, [day(n) for n in range(17)])
    for last in (16, 17, 18, 22):
        if last > 16:
            rolling.build(spark, path, sessions, [day(last)] if last < 20 else
                          [day(n) for n in range(19, last + 1)])
        first = day(last - length + 1)
        got = rolling.users_rolled(spark, path, first, day(last))
        assert plain(got) == plain(stage.users(window(sessions, first, day(last))))


def test_a_day_that_is_loaded_again_reaches_every_part(spark, tmp_path):
    path = str(tmp_path / "parts")
    rows = random_sessions(1, 24, 100)
    rolling.build(spark, path, spark.createDataFrame(rows, SESSIONS), [day(n) for n in range(24)])
    rows = [r for r in rows if r[4] != day(5)] + [
        ("new_1", "new", None, 1, day(5), "tablet", "y", "s", "m", 5, 2, True, False, 2.5, 1.0, 10, 1)]
    changed = spark.createDataFrame(rows, SESSIONS)
    rolling.build(spark, path, changed, [day(5), day(6)])
    spark.catalog.clearCache()
    got = rolling.users_rolled(spark, path, day(0), day(23))
    assert plain(got) == plain(stage.users(changed))
    # without its longer spans, as after a run that stopped half-way, a window is made of days
    assert any("days=8" in f for f in rolling.cover(spark, path, day(0), day(23)))
    for size in rolling.SIZES[1:]:
        for start in rolling.stored(spark, path, size):
            rolling.tables.drop(spark, rolling.folder(path, size, start))
    assert all("days=1/" in f for f in rolling.cover(spark, path, day(0), day(23)))
    assert plain(rolling.users_rolled(spark, path, day(0), day(23))) == plain(stage.users(changed))
    assert rolling.forget(spark, path, day(20)) == len({r[4] for r in rows if r[4] < day(20)})
    assert rolling.users_rolled(spark, path, day(0), day(10)) is None


def test_parts_of_a_day_read_that_day_only(w):
    sessions = w.table("stg_sessions")
    one = F.lit(dt.date(2024, 1, 15))
    text = rolling.day_parts(
        sessions.where(F.col("session_date") == one),
        sessions.where(F.col("session_date") == F.date_sub(one, 1)).select(
            "session_date", "session_id", *rolling.USER))._jdf.queryExecution().executedPlan().toString()
    # the day itself, the ids of the day before, and what prunes one of them by the other
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(session_date" in s for s in scans)
    assert sum("events_count" in s or "ga_session_id" in s for s in scans) <= 2


def test_a_window_of_ninety_days_is_at_most_22_parts(spark, monkeypatch):
    every = {day(n) for n in range(-100, 400)}
    monkeypatch.setattr(rolling, "stored", lambda s, p, size: {d for d in every if rolling.aligned(d, size) == d})
    for n in range(130):
        found = rolling.cover(spark, "p", day(n), day(n + 89))
        assert len(found) <= 22


FLAT = ("user_pseudo_id string, event_timestamp bigint, src_event_id bigint, event_name string, "
        "event_date_partition date, is_conversion_event boolean, is_lead_event boolean")


def flat_rows(seed, n, days):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        d = rng.randrange(days)
        rows.append((rng.choice(["a", "b", "hot", "hot", "hot", None]), micros(rng.random() * 24, 1 + d),
                     i, "purchase", day(d), rng.random() < 0.7, rng.random() < 0.3))
    return rows


def lifetime_numbers(spark, path):
    spark.catalog.refreshByPath(path)
    return {r.src_event_id: (r.conversion_number, r.is_first_conversion)
            for r in spark.read.parquet(path).collect()}


def brute_numbers(rows):
    out = {}
    for user in {r[0] for r in rows}:
        own = sorted((r[1], r[2]) for r in rows if r[0] == user and (r[5] or r[6]))
        out |= {i: (n, n == 1) for n, (_, i) in enumerate(own, 1)}
    return out


@pytest.mark.parametrize("backfilled", [True, False])
def test_lifetime_numbers_day_by_day_and_again(spark, tmp_path, backfilled):
    counters, numbers = str(tmp_path / "c"), str(tmp_path / "n")
    rows = flat_rows(2, 250, 6)
    flat = spark.createDataFrame(rows, FLAT)
    start = 0
    if backfilled:
        lifetime.backfill(spark, counters, numbers, flat, day(2))
        start = 3
    for n in range(start, 6):
        lifetime.load_day(spark, counters, numbers, flat, day(n))
    assert lifetime_numbers(spark, numbers) == brute_numbers(rows)
    # late conversions of day 3: it and the days after it are loaded again, oldest first
    rows += [("hot", micros(1.5, 4), 1000, "purchase", day(3), True, False),
             ("new", micros(2.5, 4), 1001, "purchase", day(3), True, False)]
    flat = spark.createDataFrame(rows, FLAT)
    for n in (3, 4, 5):
        lifetime.load_day(spark, counters, numbers, flat, day(n), keep=2)
    assert lifetime_numbers(spark, numbers) == brute_numbers(rows)
    assert lifetime.through(spark, counters) == [day(4), day(5)]
    # the counters needed are gone: the days since are counted from the events
    lifetime.load_day(spark, counters, numbers, flat, day(2))
    assert lifetime.through(spark, counters) == [day(2)]
    lifetime.load_day(spark, counters, numbers, flat, day(5))
    assert lifetime_numbers(spark, numbers) == brute_numbers(rows)


def test_unknown_users_stay_cut_into_slots(spark):
    df = spark.createDataFrame(flat_rows(3, 20, 2), FLAT)
    before = spark.createDataFrame([(None, 7), ("a", 2)], lifetime.COUNTERS)
    got = {r.src_event_id: r.conversion_number for r in lifetime.numbered_day(df, before).collect()}
    assert min(n for i, n in got.items() if df.where(F.col("src_event_id") == i).first()[0] is None) == 8
    text = lifetime.numbered_day(df, before)._jdf.queryExecution().executedPlan().toString()
    assert "_slot" in [x for x in text.splitlines() if "Exchange hashpartitioning" in x][0]


def test_day_parts_shuffle_by_session_and_by_user_only(spark):
    rows = spark.createDataFrame(random_sessions(5, 4, 40), SESSIONS)
    before = rows.select("session_date", "session_id", *rolling.USER)
    text = rolling.day_parts(rows, before)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_repeated_sessions_and_unknown_users_count_as_before(spark):
    known = ("s1", "u", None, 1, day(1), "a", "y", "s", "m", 5, 2, True, None, 2.5, 1.0, 10, 1)
    unknown = (None, None, None, None, day(1), "a", "y", "s", "m", 3, 1, None, True, None, None, None, None)
    rows = spark.createDataFrame([known, known, unknown, unknown], SESSIONS)
    before = spark.createDataFrame([(day(0), "s1", "u", None), (day(0), "s1", "u", None),
                                    (day(0), None, None, None), (day(0), "s9", "u", None)],
                                   "session_date date, session_id string, user_pseudo_id string, user_id string")
    got = {r.user_pseudo_id: r for r in rolling.day_parts(rows, before).collect()}
    assert set(got) == {"u", None}
    assert (got["u"].sessions, got["u"].carried, got["u"].events, got["u"].conversions) == (1, 1, 10, 2)
    assert (got[None].sessions, got[None].carried, got[None].events, got[None].leads) == (0, 0, 6, 2)
    assert (got["u"].timed, got[None].timed, got[None].seconds, got[None].value) == (2, 0, None, None)
