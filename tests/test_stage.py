"""Flattening, sessions and users on hand-made rows."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickstar.operators import stage
from tests.rows import event, micros, param, raw


def test_flatten_keeps_every_row_and_maps_nulls(spark):
    rows = raw(spark, event(params=[param("page_location", "ftp://x")], name=None, session=None),
               event(at=None, user=None))
    flat = stage.flatten(rows).orderBy("event_name").collect()
    assert len(flat) == 2
    assert flat[0]["session_id"] is None and flat[0]["page_domain"] is None
    assert flat[0]["is_conversion_event"] is False
    assert flat[1]["session_id"] is None and flat[1]["event_date_partition"] == dt.date(2024, 1, 15)


def test_first_and_last_follow_time_then_sequence_and_keep_nulls(spark):
    t = micros(1)
    rows = raw(
        spark,
        event(t, seq=2, params=[param("page_location", "b")], device=("mobile",) + (None,) * 4),
        event(t, seq=1, params=[], device=(None,) * 5, traffic=("n", "organic", "google")),
        event(t + 5, seq=0, params=[param("page_location", "c"), param("utm_source", "late")]))
    s = stage.sessions(stage.flatten(rows)).first()
    assert s["landing_page"] is None and s["exit_page"] == "c"
    assert s["device_category"] is None
    assert (s["source"], s["medium"]) == ("google", "organic")
    assert s["events_count"] == 3 and s["unique_events_count"] == 1


def test_session_duration_by_clock(spark):
    flat = stage.flatten(raw(spark, event(micros(1)), event(micros(1, plus=90_999_999))))
    assert stage.sessions(flat).first()["session_duration_seconds"] == 0
    assert stage.sessions(flat, "event").first()["session_duration_seconds"] == 90


def test_midnight_and_login_split_the_grain_but_not_the_conformed_session(spark):
    flat = stage.flatten(raw(
        spark, event(micros(23.9), seq=0), event(micros(23.95), seq=1, user_id="c1"),
        event(micros(0.1, 16), seq=2, user_id="c1", day=16)))
    assert stage.sessions(flat).count() == 3
    one = stage.sessions_conformed(flat).collect()
    assert len(one) == 1
    assert one[0]["user_id"] == "c1" and one[0]["session_date"] == dt.date(2024, 1, 15)
    assert one[0]["session_duration_seconds"] == 720


def test_conversion_value_strict_and_lenient(spark):
    flat = stage.flatten(raw(spark, event(params=[param("conversion_value", "12.5")]),
                             event(seq=1, params=[param("conversion_value", "oops")])))
    with pytest.raises(PySparkException):
        stage.sessions(flat).collect()
    assert stage.sessions(flat, lenient=True).first()["total_conversion_value"] == 12.5


def test_sums_and_flags(spark):
    flat = stage.flatten(raw(
        spark, event(name="purchase", seq=0, params=[param("conversion_value", "2")],
                     shop=(1, 5.0, "USD")),
        event(name="purchase", seq=1, shop=(1, 7.0, "USD")),
        event(name="form_submit", seq=2, params=[param("session_engaged", whole=1)]),
        event(name="scroll", seq=3)))
    s = stage.sessions(flat).first()
    assert (s["max_purchase_revenue"], s["total_purchase_revenue"]) == (7.0, 12.0)
    assert (s["has_conversion"], s["has_lead"], s["conversion_events_count"],
            s["lead_events_count"], s["scrolls"], s["pageviews"]) == (True, True, 2, 1, 1, 0)
    assert s["session_engaged"] == 1


def test_users(spark):
    flat = stage.flatten(raw(
        spark, event(micros(1, 10), seq=0, session=7, day=10, device=("tablet",) + (None,) * 4),
        event(micros(1, 15), seq=1, session=8, name="purchase"),
        event(micros(2, 15), seq=2, session=None)))
    u = stage.users(stage.sessions(flat)).first()
    assert u["user_lifetime_days"] == 5 and u["total_sessions"] == 2
    assert u["total_conversions"] == 1 and u["primary_device_category"] == "tablet"


def test_invariants(w):
    flat, sessions = w.table("stg_events_flat"), w.table("stg_sessions")
    assert sessions.agg(F.sum("events_count")).first()[0] == flat.count()
    assert flat.count() == w.events.count()


def brute_gap(events, gap):
    out = []
    by_user = {}
    for user, t in events:
        by_user.setdefault(user, []).append(t)
    for user, times in by_user.items():
        times.sort()
        start = last = times[0]
        n = 1
        for t in times[1:]:
            if t - last < gap:
                n += 1
            else:
                out.append((user, start, last, n))
                start, n = t, 1
            last = t
        out.append((user, start, last, n))
    return sorted(out)


def test_gap_sessions_against_brute_force(spark):
    import random

    rng = random.Random(3)
    base = micros(0)
    minute = 60_000_000
    events = [("hot" if rng.random() < 0.6 else f"u{rng.randrange(5)}",
               base + rng.randrange(0, 3000) * minute) for _ in range(600)]
    df = spark.createDataFrame(events, "user_pseudo_id string, event_timestamp bigint")
    got = stage.gap_sessions(df).select(
        "user_pseudo_id", F.unix_micros("first_event_at"), F.unix_micros("last_event_at"),
        "events_count").collect()
    assert sorted(tuple(r) for r in got) == brute_gap(events, 30 * minute)


def test_gap_sessions_read_their_input_once(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([("a", 1), (None, 2)], "user_pseudo_id string, event_timestamp bigint"
                          ).write.parquet(path)
    got = stage.gap_sessions(spark.read.parquet(path))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert got.count() == 2


def test_gap_sessions_around_the_epoch_and_without_users(spark):
    """Slots do not stretch over 0, and spans of unknown visitors end with their hour."""
    minute = 60_000_000
    events = [("a", t * minute) for t in (-40, -11, 0, 18, 48, 200)]
    events += [(None, t * minute) for t in (-61, -59, -1, 0, 59, 60, 200)] + [("b", None)]
    df = spark.createDataFrame(events, "user_pseudo_id string, event_timestamp bigint")
    got = {(r[0], r[1] // minute, r[2] // minute, r[3]) for r in stage.gap_sessions(df).select(
        "user_pseudo_id", F.unix_micros("first_event_at"), F.unix_micros("last_event_at"),
        "events_count").collect()}
    assert got == {("a", -40, 18, 4), ("a", 48, 48, 1), ("a", 200, 200, 1), (None, -61, -61, 1),
                   (None, -59, -1, 2), (None, 0, 59, 2), (None, 60, 60, 1), (None, 200, 200, 1)}


def test_users_by_most_frequent_value(spark):
    rows = [("u", None, f"s{i}", i, dt.date(2024, 1, 1 + i), device, "x") for i, device in
            enumerate(["mobile", "desktop", "desktop", "tablet"])]
    names = ("user_pseudo_id string, user_id string, session_id string, ga_session_id bigint, "
             "session_date date, device_category string, country string")
    df = spark.createDataFrame(rows, names)
    for c in ("events_count", "pageviews", "session_duration_seconds", "session_engaged"):
        df = df.withColumn(c, F.lit(1))
    for c in ("has_conversion", "has_lead"):
        df = df.withColumn(c, F.lit(False))
    df = df.withColumns({"total_conversion_value": F.lit(0.0), "total_purchase_revenue": F.lit(0.0),
                         "source": F.lit("a"), "medium": F.lit("b")})
    assert stage.users(df).first()["primary_device_category"] == "mobile"
    assert stage.users(df, most_frequent=True).first()["primary_device_category"] == "desktop"


def test_unknown_users_of_one_slot_are_numbered_like_brute_force(spark):
    """Nine of ten rows without a user, all in one quarter of an hour."""
    import random

    from clickstar.operators.numbering import number_rows

    rng = random.Random(6)
    base = micros(3)
    rows = [(None if i % 10 else f"u{i % 3}", base + rng.randrange(0, 900) * 1_000_000, i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "user_pseudo_id string, event_timestamp bigint, "
                                     "src_event_id bigint")
    got = {r["src_event_id"]: r["n"] for r in number_rows(df, ["user_pseudo_id"], "n").collect()}
    want = {}
    for user in {r[0] for r in rows}:
        own = sorted((t, i) for u, t, i in rows if u == user)
        want |= {i: n for n, (_, i) in enumerate(own, 1)}
    assert got == want


def test_different_names_of_a_session_are_counted(spark):
    names = ["page_view", "scroll", "page_view", None, "click"]
    flat = stage.flatten(raw(spark, *[event(micros(1 + i), n, seq=i) for i, n in enumerate(names)],
                             event(micros(9), None, seq=9, session=2)))
    for form in (stage.sessions(flat), stage.sessions_conformed(flat)):
        got = {r.ga_session_id: r.unique_events_count for r in form.collect()}
        assert got == {1: 3, 2: 0} and dict(form.dtypes)["unique_events_count"] == "bigint"
