"""Streams against batch: any batch size and file order, duplicates, restarts, compaction."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from clickstar.operators import dims as D
from clickstar.operators import stage, tables
from clickstar.schemas import TABLES
from clickstar.streaming import jobs
from tests.rows import event, micros, raw


def write(spark, root, *events):
    rows = raw(spark, *events).drop("table_suffix")
    rows.write.mode("append").partitionBy("event_date").parquet(root)


def rows_of(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def month_of_events():
    """30 days, some users and sessions that meet in several files, unknown users."""
    rng = random.Random(4)
    out = []
    for day in range(1, 31):
        for n in range(12):
            user = rng.choice(["u1", "u2", "u3", None])
            out.append(event(micros(rng.choice([1, 1.2, 9, 23.9]), day, n), seq=day * 100 + n,
                             name=rng.choice(["page_view", "scroll", "purchase"]), user=user,
                             session=rng.choice([1, 2, None]), day=day))
    return out


@pytest.fixture(scope="module")
def newest_first(spark, tmp_path_factory):
    """One file a day, the newest day written first by its modification time."""
    root = str(tmp_path_factory.mktemp("backlog") / "raw")
    events = month_of_events()
    raw(spark, *events).drop("table_suffix").coalesce(1).write.partitionBy("event_date").parquet(root)
    for day in range(1, 31):
        folder = f"{root}/event_date=202401{day:02d}"
        for name in os.listdir(folder):
            os.utime(f"{folder}/{name}", (1.7e9 - day * 1000,) * 2)
    return root, stage.flatten(raw(spark, *events))


@pytest.mark.parametrize("files", [3, 1000])
def test_volume_and_sessions_do_not_depend_on_batches(spark, newest_first, tmp_path, files):
    root, flat = newest_first
    source = lambda: jobs.open_stream(spark, root, files_per_batch=files)
    v, s, g = (str(tmp_path / n) for n in ("v", "s", "g"))
    jobs.stream_volume(source(), v, f"{v}-ck", every=4).awaitTermination()
    got = jobs.daily_volume(spark, v)
    want = flat.groupBy(F.col("event_date_partition").alias("date")).agg(
        F.count("*").alias("events_count"), F.count("session_id").alias("events_with_session"),
        F.count_distinct("session_id").alias("approx_sessions"))
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    jobs.stream_sessions(source(), s, f"{s}-ck", every=4).awaitTermination()
    want = stage.sessions(flat, "event").drop("unique_events_count")
    assert rows_of(jobs.sessions_so_far(spark, s), *want.columns) == rows_of(want, *want.columns)
    jobs.stream_gap_sessions(source(), g, f"{g}-ck", every=3).awaitTermination()
    want = stage.gap_sessions(flat)
    assert rows_of(jobs.gap_sessions_so_far(spark, g), *want.columns) == rows_of(want, *want.columns)


@pytest.mark.parametrize("files, slot", [(1, 60), (2, 60), (1, 15)])
def test_unknown_users_of_an_hour_spread_over_batches(spark, tmp_path, files, slot):
    root, out = str(tmp_path / "raw"), str(tmp_path / "g")
    events = [event(micros(hour), seq=n, user=user) for n, (hour, user) in enumerate([
        (9.7, None), (9.1, None), (9.2, "u1"), (10.1, None), (9.4, None), (9.5, "u1"),
        (9.05, None), (10.2, None)])]
    for e in events:
        write(spark, root, e)
    jobs.stream_gap_sessions(jobs.open_stream(spark, root, files_per_batch=files), out, f"{out}-ck",
                             every=3, slot_minutes=slot).awaitTermination()
    want = stage.gap_sessions(stage.flatten(raw(spark, *events)), slot_minutes=slot)
    got = jobs.gap_sessions_so_far(spark, out, slot_minutes=slot)
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    if slot == 60:
        assert sorted(r.events_count for r in got.where("user_pseudo_id IS NULL").collect()) == [2, 4]


def test_compaction_leaves_few_folders_and_one_result(spark, newest_first, tmp_path):
    root, _ = newest_first
    out = str(tmp_path / "v")
    jobs.stream_volume(jobs.open_stream(spark, root, files_per_batch=2), out, f"{out}-ck",
                       every=3).awaitTermination()
    found = {t: tables.numbered_folders(spark, f"{out}/tier={t}", "start") for t in range(3)}
    assert found == {0: [12, 13, 14], 1: [9], 2: [0]}
    # a crash after a combined table was written leaves parts that it covers already
    before = rows_of(jobs.daily_volume(spark, out), "date", "events_count")
    spark.read.parquet(f"{out}/tier=1/start=9").write.parquet(f"{out}/tier=0/start=10")
    assert rows_of(jobs.daily_volume(spark, out), "date", "events_count") == before
    jobs.compact(spark, out, jobs.combined_volume, 3, 12)
    assert 10 not in tables.numbered_folders(spark, f"{out}/tier=0", "start")
    assert rows_of(jobs.daily_volume(spark, out), "date", "events_count") == before


def test_a_row_is_written_once_per_tier(spark, tmp_path, monkeypatch):
    """27 batches of one row by threes: no row is written more than 1 + 3 times."""
    out, written = str(tmp_path / "p"), []
    replace = tables.write_replace
    monkeypatch.setattr(tables, "write_replace", lambda df, path: (written.append(df.count()), replace(df, path)))
    write = jobs._parts(out, lambda df: df, lambda df: df, 3)
    for n in range(28):
        write(spark.createDataFrame([(n,)], "n int").coalesce(1), n)
    assert sorted(written) == [3] * 9 + [9] * 3 + [27]
    assert len(jobs.part_folders(spark, out, 3)) == 2
    assert sorted(r.n for r in jobs.open_parts(spark, out).collect()) == list(range(28))


def test_spans_are_chained_when_parts_are_combined(spark, newest_first, tmp_path):
    root, flat = newest_first
    out = str(tmp_path / "g")
    jobs.stream_gap_sessions(jobs.open_stream(spark, root, files_per_batch=1), out, f"{out}-ck",
                             every=3).awaitTermination()
    (top,) = tables.numbered_folders(spark, f"{out}/tier=3", "start")
    rows = spark.read.parquet(f"{out}/tier=3/start={top}")
    assert rows.count() == stage.combined_spans(rows).count()


BEATS = "timestamp timestamp"


def test_a_silent_day_alerts(spark, tmp_path):
    """Nothing arrives on the 17th and after; the heartbeat still comes."""
    root, v, beats, out = (str(tmp_path / n) for n in ("raw", "v", "b", "a"))
    for day, n in ((14, 10), (15, 10), (16, 7)):
        write(spark, root, *[event(micros(1, day), seq=i, day=day) for i in range(n)])
    jobs.stream_volume(jobs.open_stream(spark, root), v, f"{v}-ck").awaitTermination()

    def beat(*times):
        spark.createDataFrame([(t,) for t in times], BEATS).write.mode("append").parquet(beats)
        jobs.stream_alerts(spark.readStream.schema(BEATS).parquet(beats), v, out, f"{out}-ck"
                           ).awaitTermination()
        return {(r.as_of, r.alert_type, r.check_date.day) for r in jobs.open_alerts(spark, out)
                .where("status = 'FAIL'").collect()}

    at = lambda day, hour: dt.datetime(2024, 1, day, hour)
    drop = (dt.date(2024, 1, 17), "volume_drop", 16)
    assert beat(at(17, 1), at(17, 2)) == {drop}
    assert beat(at(17, 9)) == {drop}
    fails = beat(at(19, 1))
    assert {(k, d) for as_of, k, d in fails if as_of == dt.date(2024, 1, 19)} == {
        ("volume_drop", 16), ("missing_daily_data", 17), ("missing_daily_data", 18), ("volume_drop", 17)}


def test_flatten_restarts_where_it_stopped(spark, tmp_path):
    source, out, ck = (str(tmp_path / n) for n in ("raw", "out", "ck"))
    write(spark, source, event(micros(1), seq=0))
    jobs.stream_flatten(jobs.open_stream(spark, source), out, ck).awaitTermination()
    write(spark, source, event(micros(2), seq=1), event(micros(1, 16), seq=2, day=16))
    jobs.stream_flatten(jobs.open_stream(spark, source), out, ck).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r[0] for r in got.select("src_event_id").collect()) == [0, 1, 2]


def test_sessions_grow_over_batches(spark, tmp_path):
    source, out, ck = (str(tmp_path / n) for n in ("raw", "out", "ck"))
    write(spark, source, event(micros(1), seq=0), event(micros(1.2), seq=1, name="scroll"))
    jobs.stream_sessions(jobs.open_stream(spark, source), out, ck).awaitTermination()
    write(spark, source, event(micros(1.5), seq=2, name="purchase"),
          event(micros(3), seq=3, user="u2"))
    jobs.stream_sessions(jobs.open_stream(spark, source), out, ck).awaitTermination()
    rows = {r["user_pseudo_id"]: r for r in jobs.sessions_so_far(spark, out).collect()}
    one = rows["u1"]
    assert (one["events_count"], one["pageviews"], one["scrolls"]) == (3, 1, 1)
    assert one["has_conversion"] is True and one["session_duration_seconds"] == 1800
    assert rows["u2"]["events_count"] == 1


def test_rows_of_a_day_long_past_still_count(spark, tmp_path):
    source, out, ck = (str(tmp_path / n) for n in ("raw", "out", "ck"))
    write(spark, source, event(micros(1, 15), seq=0))
    write(spark, source, event(micros(1, 25), seq=1, day=25))
    jobs.stream_volume(jobs.open_stream(spark, source), out, ck).awaitTermination()
    write(spark, source, event(micros(2, 15), seq=2))
    jobs.stream_volume(jobs.open_stream(spark, source), out, ck).awaitTermination()
    rows = {r["date"].day: r["events_count"] for r in jobs.daily_volume(spark, out).collect()}
    assert rows == {15: 2, 25: 1}


def test_upsert_takes_each_event_once(spark, tmp_path):
    source, out, ck, staging = (str(tmp_path / n) for n in ("raw", "out", "ck", "st"))
    table = TABLES["fact_events"]
    first = [event(micros(1), seq=0), event(micros(2), seq=1, session=None)]
    flat = stage.flatten(raw(spark, *first))
    dims = {n: D.conformed(stage.sessions(flat) if d is D.CHANNEL else flat, d)
            for n, d in D.DIMENSIONS.items()}
    for n, df in dims.items():
        tables.write_replace(df, str(tmp_path / n))
    dims = {n: spark.read.parquet(str(tmp_path / n)) for n in dims}
    write(spark, source, *first, first[0])
    jobs.stream_upsert_events(jobs.open_stream(spark, source), dims, table, out, staging,
                              ck).awaitTermination()
    write(spark, source, first[1], event(micros(3), seq=2))
    jobs.stream_upsert_events(jobs.open_stream(spark, source, files_per_batch=1), dims, table,
                              out, staging, ck).awaitTermination()
    got = tables.read_table(spark, out, table.schema)
    assert got.count() == 3 and got.where(F.col("device_key").isNull()).count() == 0
