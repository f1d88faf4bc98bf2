"""Funnels, paths and cohorts against plain versions."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickstar.operators import journeys
from tests.rows import micros

MINUTE = journeys.MINUTE
EVENTS = ("user_pseudo_id string, event_timestamp bigint, src_event_id bigint, event_name string, "
          "utm_source string, utm_medium string, traffic_source_source string, "
          "traffic_source_medium string")
STEPS = (("a", ("a1", "a2")), ("b", ("b",)), ("c", ("c",)), ("d", ("d",)))


def random_events(seed, n, span, users=6):
    """Half of the events belong to one user; many share their time."""
    rng = random.Random(seed)
    names = ["a1", "a2", "b", "c", "d", "other"]
    channels = [("google", "organic"), (None, "cpc"), ("x", None), (None, None)]
    return [("hot" if rng.random() < 0.5 else f"u{rng.randrange(users)}",
             micros(0) + rng.randrange(span) * MINUTE // 2, i, rng.choice(names),
             *rng.choice(channels), "facebook", "social") for i in range(n)]


def brute_funnel(events, window):
    step = {n: j for j, (_, group) in enumerate(STEPS) for n in group}
    reached = {}
    for user in {e[0] for e in events}:
        own = sorted((e[1], e[2], step[e[3]]) for e in events if e[0] == user and e[3] in step)
        best = -1
        for at, (start, _, s) in enumerate(own):
            if s == 0:
                done = 0
                for t, _, other in own[at + 1:]:
                    if other == done + 1 and t - start <= window:
                        done += 1
                best = max(best, done)
        if best >= 0:
            reached[user] = best + 1
    return reached


@pytest.mark.parametrize("seed,window,slot", [(0, 30, 15), (1, 120, 15), (2, 600, 7), (3, 10, 60)])
def test_funnel_equals_brute_force(spark, seed, window, slot):
    events = random_events(seed, 300, 3000)
    df = spark.createDataFrame(events, EVENTS)
    got = {}
    for r in journeys.funnel_users(df, STEPS, window, slot).collect():
        steps = [r[f"s{j}"] is not None for j in range(1, 5)]
        assert steps == sorted(steps, reverse=True)
        got[r.user_pseudo_id] = sum(steps)
    assert got == brute_funnel(events, window * MINUTE)


def test_funnel_ties_window_and_entry_channel(spark):
    t = micros(0)
    rows = [("u", t, 2, "b"), ("u", t, 1, "a1"), ("u", t + 30 * MINUTE, 3, "c"),
            ("v", t, 2, "a1"), ("v", t, 1, "b"),  # b comes before a
            ("w", t, 1, "a1"), ("w", t + MINUTE, 2, "b"), ("w", t + 30 * MINUTE + 1, 3, "c"),
            (None, t, 1, "a1"), ("x", None, 1, "a1"), ("y", t, 1, None), ("z", t, 1, "d")]
    df = spark.createDataFrame([(*r, "google", "cpc", None, None) for r in rows], EVENTS)
    got = {r.user_pseudo_id: r for r in journeys.funnel_users(df, STEPS, 30).collect()}
    assert {u: sum(r[f"s{j}"] is not None for j in range(1, 5)) for u, r in got.items()} == {
        "u": 3, "v": 1, "w": 2}
    assert {r.channel_group for r in got.values()} == {"Paid Search"}
    out = journeys.event_funnel(df, STEPS, 30).collect()
    assert [(r.step, r.users, r.step_rate, r.entry_rate) for r in sorted(out)] == [
        (1, 3, 100.0, 100.0), (2, 2, 66.67, 66.67), (3, 1, 50.0, 33.33), (4, 0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        journeys.event_funnel(df, (("a", ("x",)), ("b", ("x",))))


def test_a_hot_user_is_dealt_by_slots(spark):
    """Events are shuffled by user and slot; only one row per slot is shuffled by user."""
    df = spark.createDataFrame(random_events(5, 10, 100), EVENTS)
    text = journeys.event_funnel(df, STEPS)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_pseudo_id" in text and "Join" not in text and "Window" not in text
    first = [line for line in text.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "slot" in first


PAGES = "session_id string, page_location string, event_timestamp bigint, src_event_id bigint"


def visits(seed, n):
    rng = random.Random(seed)
    return [("long" if rng.random() < 0.6 else f"s{rng.randrange(20)}",
             rng.choice(["p1", "p2", "p3", None]), micros(0) + rng.randrange(900) * MINUTE, i)
            for i in range(n)] + [(None, "p1", micros(0), -1)]


def brute_grams(rows, n):
    out = Counter()
    for s in {r[0] for r in rows if r[0]}:
        pages = [p for _, _, p in sorted((t, i, p) for x, p, t, i in rows if x == s and p)]
        out.update(tuple(pages[i:i + n]) for i in range(len(pages) - n + 1))
    return out


@pytest.mark.parametrize("n,stretch", [(2, 1024), (2, 3), (3, 3), (4, 4)])
def test_page_grams_over_stretches(spark, n, stretch):
    rows = visits(n, 400)
    got = Counter(tuple(r.pages) for r in journeys.page_grams(
        spark.createDataFrame(rows, PAGES), n, stretch).collect())
    assert got == brute_grams(rows, n)


def test_transitions_and_paths(spark):
    rows = visits(9, 300)
    df = spark.createDataFrame(rows, PAGES)
    want = brute_grams(rows, 2)
    got = journeys.page_transitions(df).collect()
    assert {(r.from_page, r.to_page): r.transitions for r in got} == dict(want)
    assert abs(sum(r.share_of_from for r in got if r.from_page == "p1") - 100) < 0.05
    top = [(r.path, r.occurrences) for r in journeys.top_paths(df, 2, 4).collect()]
    assert top == sorted(((" > ".join(p), c) for p, c in want.items()), key=lambda x: (-x[1], x[0]))[:4]
    assert journeys.top_paths(df.where("false")).collect() == []


@pytest.mark.parametrize("tracked", [8, 64, 10_000])
def test_frequent_is_exact_on_skewed_and_flat_items(spark, tracked):
    """With few tracked items the flat case must fall back to counting all of them."""
    rng = random.Random(tracked)
    skewed = [f"i{min(int(rng.paretovariate(0.9)), 400)}" for _ in range(3000)]
    flat = [f"i{i % 700}" for i in range(3000)]
    for items in (skewed, flat, ["a", "b"], []):
        df = spark.createDataFrame([(x,) for x in items] + [(None,)], "item string")
        got = [tuple(r) for r in journeys.frequent(df, 5, tracked).collect()]
        assert got == sorted(Counter(items).items(), key=lambda x: (-x[1], x[0]))[:5]


def test_cohorts_against_brute_force(spark):
    rng = random.Random(4)
    days = [dt.date(2023, 11, 1) + dt.timedelta(days=rng.randrange(900)) for _ in range(500)]
    days += [dt.date(1965, 5, 5), dt.date(1969, 12, 29), dt.date(1969, 12, 28)]
    rows = [(f"u{rng.randrange(40)}", d) for d in days] + [(None, days[0]), ("x", None)]
    df = spark.createDataFrame(rows, "user_pseudo_id string, session_date date")
    weeks = {}
    for u, d in rows:
        if u and d:
            weeks.setdefault(u, set()).add(d - dt.timedelta(days=d.weekday()))
    cells = Counter((min(w), (x - min(w)).days // 7) for w in weeks.values() for x in w)
    parts = [journeys.user_weeks(p) for p in df.randomSplit([0.3, 0.3, 0.4], 1)]
    merged = journeys.merged_weeks(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for table in (journeys.user_weeks(df), merged):
        got = journeys.cohort_retention(table).collect()
        assert {(r.cohort_week, r.weeks_since): r.active_users for r in got} == dict(cells)
        assert all(r.cohort_users == cells[r.cohort_week, 0] for r in got)
        assert all(r.retention == round(100 * r.active_users / r.cohort_users + 1e-9, 2) for r in got)


def test_retention_rate_is_a_share_of_the_cohort(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 7)),
                                ("a", dt.date(2024, 1, 15))], "user_pseudo_id string, session_date date")
    got = journeys.cohort_retention(journeys.user_weeks(df)).orderBy("weeks_since").collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 1), 0, 2, 2, 100.0),
                                       (dt.date(2024, 1, 1), 2, 1, 2, 50.0)]
