"""Dimensions, fan-out, numbering and facts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickstar.operators import dims as D
from clickstar.operators import facts, quality, stage
from clickstar.operators.numbering import number_rows
from tests.compare import difference
from tests.rows import event, micros, raw


def test_calendar_against_python(spark):
    rows = D.dim_date(spark).collect()
    assert len(rows) == 4018
    for r in rows:
        d = r["date_key"]
        iso = d.isocalendar()
        sunday = d - dt.timedelta(days=d.isoweekday() % 7)
        assert (r["year"], r["month"], r["day"]) == (d.year, d.month, d.day)
        assert (r["iso_year"], r["iso_week"]) == (iso[0], iso[1])
        assert r["week"] == int(d.strftime("%U"))
        assert r["week_start_date"] == sunday
        assert r["week_start_date_monday"] == d - dt.timedelta(days=d.weekday())
        assert r["day_of_week"] == d.isoweekday() % 7 + 1
        assert r["day_of_year"] == d.timetuple().tm_yday
        assert r["is_weekend"] is (d.weekday() >= 5)
        assert (r["month_name"], r["month_name_short"], r["day_name"], r["day_name_short"]) == (
            d.strftime("%B"), d.strftime("%b"), d.strftime("%A"), d.strftime("%a"))
        assert (r["quarter_name"], r["year_quarter"], r["year_month"]) == (
            f"Q{(d.month + 2) // 3}", f"{d.year}-Q{(d.month + 2) // 3}", d.strftime("%Y-%m"))
    assert sum(r["is_holiday"] for r in rows) == 3


def test_calendar_against_sql(spark, con):
    from clickstar.plans.oracle import with_ctes

    assert difference(D.dim_date(spark), con, with_ctes("SELECT * FROM d_date")) is None


def star(spark, flat, conformed):
    rows = {n: (stage.sessions(flat) if d is D.CHANNEL else flat)
            for n, d in D.DIMENSIONS.items()}
    build = D.conformed if conformed else D.members
    return {n: build(rows[n], d) for n, d in D.DIMENSIONS.items()}


def two_models(spark):
    """One category and system, two models: a join on those two columns doubles rows."""
    return stage.flatten(raw(
        spark,
        event(micros(1), seq=0, session=1, device=("mobile", "Apple", "m1", "iOS", "10")),
        event(micros(2), seq=1, session=2, device=("mobile", "Apple", "m2", "iOS", "11")),
        event(micros(3), seq=2, session=3, name="purchase",
              device=(None, None, None, "Android", None))))


def test_members_repeat_rows_and_conformed_do_not(spark):
    flat = two_models(spark)
    sessions = stage.sessions(flat)
    wide = facts.fact_sessions(sessions, star(spark, flat, False))
    assert wide.count() == 5
    assert wide.where("device_key IS NULL").count() == 1
    narrow = facts.fact_sessions(sessions, star(spark, flat, True), conformed=True).collect()
    assert len(narrow) == 3
    assert all(r["device_key"] and r["geo_key"] and r["campaign_key"] and r["channel_key"]
               for r in narrow)


def test_conformed_has_one_row_per_lookup_and_an_unknown_member(w):
    for name, dim in D.DIMENSIONS.items():
        rows = w.dim(name, True)
        n = rows.count()
        assert n == rows.select(*dim.lookup).distinct().count()
        assert n == rows.select(dim.key).distinct().count()
        assert rows.where(F.col(dim.key) == D.unknown_key(dim)).count() == 1


@pytest.mark.parametrize("name", list(D.DIMENSIONS))
def test_extend_equals_rebuild(w, name):
    dim = D.DIMENSIONS[name]
    rows = w.table("stg_sessions" if dim is D.CHANNEL else "stg_events_flat")
    date = F.col("session_date" if dim is D.CHANNEL else "event_date_partition")
    cut = F.lit(dt.date(2024, 1, 10))
    step = D.extend(D.conformed(rows.where(date < cut), dim), rows.where(date >= cut), dim)
    whole = D.conformed(rows, dim)
    assert step.exceptAll(whole).isEmpty() and whole.exceptAll(step).isEmpty()


def test_conformed_facts_keep_the_grain_and_resolve(w):
    sessions, fact = w.table("stg_sessions"), w.table("fact_sessions")
    assert fact.count() == sessions.count()
    dims = {**w.dims(True), "dim_date": w.table("dim_date")}
    one = quality.orphan_counts(fact, dims, list(quality.REFERENCES)).first()
    assert all(one[f"{n}_integrity"] == 0 for n in quality.REFERENCES)
    events = w.table("fact_events")
    assert events.count() == events.select("event_id").distinct().count() == w.events.count()
    conv = w.table("fact_conversions")
    assert conv.count() == conv.select("conversion_id").distinct().count()
    assert conv.where("event_type_key IS NULL").count() == 0


def test_conversion_ids(w):
    ids = w.fact_conversions().where("session_id IS NOT NULL").select("conversion_id").first()[0]
    assert "_2024-01-" in ids and " 00:00:00+00_" in ids


def brute_numbers(rows):
    out = {}
    groups = {}
    for g, t, i in rows:
        groups.setdefault(g, []).append((t is not None, t or 0, i))
    for g, items in groups.items():
        for n, (_, _, i) in enumerate(sorted(items), 1):
            out[i] = n
    return out


def test_numbers_against_brute_force_with_a_hot_group(spark):
    rng = random.Random(5)
    rows = []
    for i in range(800):
        group = rng.choice(["hot"] * 4 + [None, "", "a", "b"])
        t = None if rng.random() < 0.02 else micros(0) + rng.randrange(0, 86_400_000_000, 7)
        if rng.random() < 0.2:
            t = micros(5)
        rows.append((group, t, i))
    df = spark.createDataFrame(
        rows, "user_pseudo_id string, event_timestamp bigint, src_event_id bigint")
    numbered = number_rows(df, ["user_pseudo_id"], "n")
    assert numbered.columns == [*df.columns, "n"]
    assert {r["src_event_id"]: r["n"] for r in numbered.collect()} == brute_numbers(rows)


def test_numbers_per_day_and_lifetime(spark):
    flat = stage.flatten(raw(
        spark, event(micros(1, 14), "contact", seq=0, day=14),
        event(micros(1, 15), "purchase", seq=1), event(micros(2, 15), "purchase", seq=2)))
    per_day = facts.numbered_conversions(flat).orderBy("src_event_id").collect()
    assert [r["conversion_number"] for r in per_day] == [1, 1, 2]
    assert [r["is_first_conversion"] for r in per_day] == [True, True, False]
    life = facts.numbered_conversions(flat, lifetime=True).orderBy("src_event_id").collect()
    assert [r["conversion_number"] for r in life] == [1, 2, 3]


def test_conversion_type(spark):
    flat = stage.flatten(raw(spark, event(name="generate_lead", seq=0),
                             event(name="conversion", seq=1), event(name="contact", seq=2)))
    got = {r["event_name"]: r["t"] for r in flat.select(
        "event_name", facts.conversion_type().alias("t")).collect()}
    assert got == {"generate_lead": "lead", "conversion": "purchase", "contact": "lead"}
