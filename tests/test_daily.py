"""The daily load from a written export."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickstar import schemas
from clickstar.operators import quality, tables
from clickstar.params import RunParams
from clickstar.plans import daily
from clickstar.sources import adapter

DAYS = [dt.date(2024, 1, 14), dt.date(2024, 1, 15)]


def snapshot(load, name):
    rows = load.read(name).drop("_etl_timestamp")
    return sorted(map(repr, rows.collect()))


@pytest.fixture(scope="module")
def loaded(spark, w, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("daily"))
    export = f"{root}/raw"
    raw = adapter.raw_export(w.events).where(F.col("event_date").isin("20240114", "20240115"))
    tables.write_partitioned(raw, export, "event_date")
    loads = [daily.run_daily(spark, export, root, RunParams(day)) for day in DAYS]
    return spark, export, root, loads[-1]


def test_days_accumulate_and_facts_match_stage(loaded):
    _, _, _, load = loaded
    flat, sessions = load.read("stg_events_flat"), load.read("stg_sessions")
    assert [r[0] for r in flat.select("event_date_partition").distinct().orderBy(
        "event_date_partition").collect()] == DAYS
    assert load.read("fact_sessions").count() == sessions.count()
    assert load.read("fact_events").count() == flat.count()
    assert sessions.agg(F.sum("events_count")).first()[0] == flat.count()
    assert load.read("stg_users").count() == sessions.select(
        "user_pseudo_id", "user_id").distinct().count()


def test_every_key_resolves_and_checks_pass_but_for_missing_sessions(loaded):
    _, _, _, load = loaded
    dims = {**load.dims(True), "dim_date": load.read("dim_date")}
    one = quality.orphan_counts(load.read("fact_sessions"), dims,
                                list(quality.REFERENCES)).first()
    assert all(one[f"{n}_integrity"] == 0 for n in quality.REFERENCES)
    log = load.read("data_quality_log")
    per_day = log.groupBy("check_date").count().collect()
    assert len(per_day) == 2 and {r["count"] for r in per_day} == {7 + 18}
    failed = {r[0] for r in log.where("status = 'FAIL'").select("assertion_name").collect()}
    assert failed <= {"events_without_session", "stage_events_missing_session_id",
                      "stage_sessions_unique"}
    once = sorted(map(repr, log.collect()))
    load.checks()
    assert sorted(map(repr, load.read("data_quality_log").collect())) == once


def test_run_log_and_summary(loaded):
    _, _, _, load = loaded
    log = load.read("etl_run_log")
    assert log.where("status <> 'success'").count() == 0
    assert log.where(F.col("run_date") == F.lit(DAYS[1])).count() == 16
    assert log.where("task_id = 'fact_events'").agg(F.min("rows_processed")).first()[0] > 0
    one = load.read("daily_summary").first()
    assert one["report_date"] == DAYS[1]
    assert one["sessions_count"] == one["fact_sessions_count"] > 0


def test_rerun_changes_nothing_and_correction_changes_listed_columns(loaded):
    spark, export, root, load = loaded
    names = ["stg_events_flat", "stg_sessions", "fact_sessions", "fact_events",
             "fact_conversions", "dim_device", "dim_campaign", "dim_channel"]
    before = {n: snapshot(load, n) for n in names}
    again = daily.DailyLoad(spark, export, root, RunParams(DAYS[1]))
    again.stg_events_flat()
    again.stg_sessions()
    for n in ("dim_device", "dim_campaign", "dim_channel"):
        again.dimension(n)
    for n in ("fact_sessions", "fact_events", "fact_conversions"):
        again.fact(n)
    assert {n: snapshot(again, n) for n in names} == before

    corrected = spark.read.parquet(f"{export}/event_date=20240115").withColumn(
        "ecommerce", F.col("ecommerce").withField(
            "purchase_revenue", F.col("ecommerce.purchase_revenue") * 2)).withColumn(
        "device", F.col("device").withField("category", F.lit("desktop")))
    tables.write_replace(corrected, f"{root}/fix")
    fixed = spark.read.parquet(f"{root}/fix")
    tables.write_partitioned(fixed.withColumn("event_date", F.lit("20240115")), export,
                             "event_date")
    again.stg_events_flat()
    again.stg_sessions()
    again.fact("fact_events")
    new = again.read_day("fact_events").where("purchase_revenue IS NOT NULL")
    raw = {r["src_event_id"]: r["r"] for r in fixed.select(
        "src_event_id", F.col("ecommerce.purchase_revenue").alias("r")).collect()}
    for r in new.collect():
        assert r["purchase_revenue"] == raw[int(r["event_id"].rsplit("_", 1)[1])]
    keys = {r[0] for r in again.read_day("fact_events").select("device_key").distinct().collect()}
    assert len(keys) > 1  # first-load keys stay although every device became a desktop


def test_missing_export_stops_the_run(loaded):
    spark, export, root, _ = loaded
    with pytest.raises(daily.RawDataMissing):
        daily.run_daily(spark, export, f"{root}/other", RunParams(dt.date(2023, 1, 1)))
    log = daily.DailyLoad(spark, export, f"{root}/other", RunParams()).read("etl_run_log")
    row = log.first()
    assert (row["status"], row["task_id"]) == ("failed", "check_raw_data")
    assert row["error_message"] == "2023-01-01"


def test_quality_exit_code(loaded):
    _, _, _, load = loaded
    failed = quality.failed_names(load.checks())
    assert daily.run_quality(load) == (1 if failed else 0)


def test_scheduled_checks_stop_after_a_failing_group(loaded):
    spark, export, root, load = loaded
    done = daily.run_scheduled_checks(load)
    assert [n for n, _ in done[:4]] == [
        "check_events_volume", "check_events_without_session",
        "check_negative_session_duration", "check_sessions_volume"]
    passed = all(ok for _, ok in done[:4])
    assert len(done) == (6 if passed else 4)
    empty = daily.DailyLoad(spark, export, root, RunParams(dt.date(2023, 1, 1)))
    assert len(daily.run_scheduled_checks(empty)) == 4


def test_retention_drops_days_past_two_years(loaded):
    spark, export, root, load = loaded
    assert set(load.retention().values()) == {0}
    later = daily.DailyLoad(spark, export, root, RunParams(dt.date(2026, 1, 14)))
    assert later.retention() == {"stg_events_flat": 1, "stg_sessions": 1, "fact_sessions": 1}
    for name in ("stg_events_flat", "stg_sessions", "fact_sessions"):
        assert tables.partition_days(spark, later.path(name),
                                     schemas.TABLES[name].partition) == [DAYS[1]]


def small_export(spark, root, *events):
    from tests.rows import raw

    tables.write_partitioned(raw(spark, *events).drop("table_suffix"), f"{root}/raw", "event_date")
    return f"{root}/raw"


def test_unknown_users_and_equal_names_in_one_microsecond_load_twice(spark, tmp_path):
    """NULL users in two sessions, and no sequence column in the export at all."""
    from tests.rows import event, micros, param

    root = str(tmp_path)
    events = [event(micros(1), user=None, session=1), event(micros(2), user=None, session=2),
              event(micros(3), user=None, session=None),
              event(micros(4), name="purchase", params=[param("page_title", "a")]),
              event(micros(4), name="purchase", params=[param("page_title", "b")])]
    export = small_export(spark, root, *events)
    bare = spark.read.parquet(export).drop("src_event_id")
    tables.write_replace(bare, f"{root}/bare")
    tables.write_partitioned(spark.read.parquet(f"{root}/bare").withColumn(
        "event_date", F.lit("20240115")), f"{root}/export", "event_date")
    names = ["fact_sessions", "fact_events", "fact_conversions"]
    first = daily.run_daily(spark, f"{root}/export", f"{root}/w", RunParams(DAYS[1]))
    before = {n: snapshot(first, n) for n in names}
    assert [len(before[n]) for n in names] == [4, 5, 2]
    again = daily.run_daily(spark, f"{root}/export", f"{root}/w", RunParams(DAYS[1]))
    assert {n: snapshot(again, n) for n in names} == before


def test_late_rows_of_an_earlier_day_reach_the_facts(spark, tmp_path):
    from tests.rows import event, micros

    root = str(tmp_path)
    day14 = [event(micros(1, 14), seq=0, day=14)]
    export = small_export(spark, root, *day14, event(micros(1, 15), seq=5))
    for day in DAYS:
        daily.run_daily(spark, export, f"{root}/w", RunParams(day))
    late = [event(micros(2, 14), seq=1, day=14, user="late", geo=("Asia", "Nowhere", "r", "c"))]
    small_export(spark, root, *day14, *late)
    load = daily.run_daily(spark, export, f"{root}/w", RunParams(DAYS[1]), reprocess_days=2)
    assert load.read("fact_sessions").count() == load.read("stg_sessions").count() == 3
    assert load.read("fact_events").count() == load.read("stg_events_flat").count() == 3
    geo = load.read("dim_geo")
    assert geo.count() >= 2
    log = load.read("data_quality_log").groupBy("check_date").count().collect()
    assert {r["count"] for r in log} == {25}


def test_fingerprints_tell_content_not_order(spark, w, tmp_path):
    from clickstar.sources import raw

    export = w.export.where("event_date <= '20240104'")
    known = raw.shard_fingerprints(export)
    mixed = export.repartition(5).orderBy(F.rand(1))
    assert raw.changed_shards(raw.shard_fingerprints(mixed), known).collect() == []
    one = export.where("event_date = '20240102'").limit(1)
    for other in (export.unionByName(one), export.unionByName(one).unionByName(one),
                  export.withColumn("event_name", F.when(
                      F.col("src_event_id") == one.first()["src_event_id"], "x").otherwise(F.col("event_name")))):
        assert [tuple(r) for r in raw.changed_shards(raw.shard_fingerprints(other), known).collect()] == [
            ("20240102", False)]
    assert [tuple(r) for r in raw.changed_shards(known, known.where("event_date <> '20240103'")).collect()] == [
        ("20240103", True)]


def test_a_changed_old_shard_is_loaded_again(spark, w, tmp_path):
    root = str(tmp_path)
    export, days = f"{root}/raw", ["20240110", "20240111", "20240112"]
    whole = adapter.raw_export(w.events).where(F.col("event_date").isin(days))
    late = F.col("src_event_id") % 5 == 0
    early = whole.where((F.col("event_date") < "20240112") & ~((F.col("event_date") == "20240110") & late))
    tables.write_partitioned(early, export, "event_date")
    load = daily.run_daily(spark, export, root, RunParams(dt.date(2024, 1, 11)), None)
    assert load.read("fact_events").count() == early.count()
    assert load.changed_days(load.fingerprints(30)) == []
    tables.write_partitioned(whole, export, "event_date")
    spark.catalog.refreshByPath(export)
    assert [d.day for d in load.changed_days(load.fingerprints(30))] == [10]
    load = daily.run_daily(spark, export, root, RunParams(dt.date(2024, 1, 12)), None)
    assert load.read("fact_events").count() == whole.count()
    assert load.changed_days(load.fingerprints(30)) == []
    numbers = spark.read.parquet(f"{load.path('fact_conversions')}_lifetime")
    from clickstar.operators import facts

    want = facts.numbered_conversions(load.read("stg_events_flat"), lifetime=True)
    key = ["src_event_id", "conversion_number"]
    assert sorted(map(tuple, numbers.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
    assert sorted(r.n for r in load.read("mart_rollup").where("tile_set = 'total'").groupBy(
        "session_date").agg(F.sum("sessions").alias("n")).collect()) == sorted(
        r.n for r in load.read("fact_sessions").groupBy("session_date").agg(F.count("*").alias("n")).collect())
