"""Writes, retention, rewriting and the upsert."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickstar.operators import merge, tables
from clickstar.schemas import TABLES, Table, struct

SCHEMA = struct("id string, day date, a string, b string")
PLAIN = Table("t", "stage", "day", ("id",), SCHEMA, "", ("id", "day"), ("a",))
MOVING = Table("t", "stage", "day", ("id",), SCHEMA, "", ("id",), ("a",))


def d(n):
    return dt.date(2024, 1, n)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def got(spark, path):
    return sorted((tuple(r) for r in tables.read_table(spark, path, SCHEMA).select(
        "id", "day", "a", "b").collect()), key=repr)


def test_update_subset_insert_keep(spark):
    target = rows(spark, ("1", d(1), "x", "x"), ("2", d(1), "x", "x"))
    source = rows(spark, ("2", d(1), "new", "new"), ("3", d(1), "new", "new"))
    out = {r["id"]: (r["a"], r["b"]) for r in merge.merge_rows(
        target, source, ["id"], ["a"]).collect()}
    assert out == {"1": ("x", "x"), "2": ("new", "x"), "3": ("new", "new")}


@pytest.mark.parametrize("null_safe", [True, False])
def test_target_rows_that_share_a_key_all_stay(spark, null_safe):
    target = rows(spark, ("1", d(1), "x", "x"), ("1", d(2), "y", "y"), ("1", d(2), "y", "y"),
                  ("2", d(1), "x", "x"), ("2", d(1), "z", "z"), (None, d(1), "n", "n"),
                  (None, d(1), "m", "m"))
    source = rows(spark, ("2", d(1), "new", "new"), ("3", d(1), "in", "in"), (None, d(3), "s", "s"))
    out = sorted((tuple(r) for r in merge.merge_rows(
        target, source, ["id"], ["a"], null_safe).collect()), key=repr)
    nulls = ([(None, d(1), "s", "m"), (None, d(1), "s", "n")] if null_safe else
             [(None, d(1), "m", "m"), (None, d(1), "n", "n"), (None, d(3), "s", "s")])
    assert out == sorted([("1", d(1), "x", "x"), ("1", d(2), "y", "y"), ("1", d(2), "y", "y"),
                          ("2", d(1), "new", "x"), ("2", d(1), "new", "z"), ("3", d(1), "in", "in"),
                          *nulls], key=repr)


def test_repeated_target_rows_survive_a_table_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(rows(spark, ("1", d(1), "x", "x"), ("1", d(1), "y", "y"),
                                  ("2", d(1), "x", "x")), path, "day")
    for _ in range(2):
        merge.merge_table(spark, path, rows(spark, ("3", d(1), "new", "new")), PLAIN)
        assert len(got(spark, path)) == 4
    with pytest.raises(merge.DuplicateMergeKey):
        merge.merge_table(spark, path, rows(spark, ("1", d(1), "a", "a"), ("1", d(1), "b", "b")), PLAIN)
    assert len(got(spark, path)) == 4


def test_null_keys_match_only_when_null_safe(spark):
    target = rows(spark, (None, d(1), "x", "x"))
    source = rows(spark, (None, d(1), "new", "new"))
    assert merge.merge_rows(target, source, ["id"]).count() == 1
    assert merge.merge_rows(target, source, ["id"], null_safe=False).count() == 2


def test_duplicate_source_key_raises(spark, tmp_path):
    twice = rows(spark, ("1", d(1), "x", "x"), ("1", d(1), "y", "y"))
    with pytest.raises(merge.DuplicateMergeKey):
        merge.merge_table(spark, str(tmp_path / "t"), twice, PLAIN)
    nulls = rows(spark, (None, d(1), "x", "x"), (None, d(1), "y", "y"))
    assert merge.merge_rows(nulls.limit(0), nulls, ["id"], null_safe=False).count() == 2
    with pytest.raises(merge.DuplicateMergeKey):
        merge.merge_table(spark, str(tmp_path / "n"), nulls, PLAIN)


def test_merge_is_one_shuffle(spark):
    target, source = rows(spark, ("1", d(1), "x", "x")), rows(spark, ("1", d(1), "y", "y"))
    text = merge.merge_rows(target, source, ["id", "day"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_a_merge_stopped_between_stage_and_swap_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = rows(spark, ("1", d(1), "x", "x"), ("2", d(1), "x", "x"), ("3", d(2), "x", "x"))
    merge.merge_table(spark, path, first, PLAIN)
    change = rows(spark, ("1", d(1), "new", "x"), ("4", d(2), "new", "x"), ("5", d(3), "new", "x"))
    swap = tables.swap_days
    calls = []

    def stop_at_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return swap(*args)

    monkeypatch.setattr(tables, "swap_days", stop_at_second)
    with pytest.raises(KeyboardInterrupt):
        merge.merge_table(spark, path, change, PLAIN)
    monkeypatch.setattr(tables, "swap_days", swap)
    spark.catalog.refreshByPath(path)
    assert [r[0] for r in got(spark, path)] == ["1", "2", "3"]
    # the swap of one day stopped after its old folder was set aside
    day = "day=2024-01-01"
    (tmp_path / "t.aside").mkdir()
    (tmp_path / "t" / day).rename(tmp_path / "t.aside" / day)
    assert merge.merge_table(spark, path, rows(spark), PLAIN) == 0
    spark.catalog.refreshByPath(path)
    assert [(r[0], r[2]) for r in got(spark, path)] == [
        ("1", "new"), ("2", "x"), ("3", "x"), ("4", "new"), ("5", "new")]
    assert not (tmp_path / "t.staged").exists() and not (tmp_path / "t.aside").exists()


def test_an_unfinished_stage_is_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.merge_table(spark, path, rows(spark, ("1", d(1), "x", "x")), PLAIN)
    (tmp_path / "t.staged" / "day=2024-01-01").mkdir(parents=True)
    assert tables.swap_days(spark, path) == 0
    assert len(got(spark, path)) == 1 and not (tmp_path / "t.staged").exists()


def test_table_merge_is_idempotent_and_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge.merge_table(spark, path, rows(spark, ("1", d(1), "x", "x"),
                                               (None, d(1), "n", "n")), PLAIN) == 1
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2024-01-01").iterdir()}
    day2 = rows(spark, ("1", d(2), "x", "x"), ("2", d(2), "x", "x"), (None, d(2), "n", "n"))
    merge.merge_table(spark, path, day2, PLAIN)
    once = got(spark, path)
    merge.merge_table(spark, path, day2, PLAIN)
    assert got(spark, path) == once and len(once) == 5
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2024-01-01").iterdir()}
    assert before == after


def test_matched_row_stays_in_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.merge_table(spark, path, rows(spark, ("1", d(1), "x", "x"), ("9", d(3), "x", "x")),
                      MOVING)
    n = merge.merge_table(spark, path, rows(spark, ("1", d(2), "new", "new"),
                                            ("2", d(2), "i", "i")), MOVING)
    assert n == 2
    assert got(spark, path) == [("1", d(1), "new", "x"), ("2", d(2), "i", "i"),
                                ("9", d(3), "x", "x")]


def test_empty_source_changes_nothing(spark, tmp_path):
    assert merge.merge_table(spark, str(tmp_path / "t"), rows(spark), PLAIN) == 0


def test_partitioned_write_replaces_only_given_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(rows(spark, ("1", d(1), "x", "x"), ("2", d(2), "x", "x")), path,
                             "day", ("id",))
    tables.write_partitioned(rows(spark, ("3", d(2), "y", "y")), path, "day", ("id",))
    assert [r[0] for r in got(spark, path)] == ["1", "3"]
    assert tables.partition_days(spark, path, "day") == [d(1), d(2)]
    tables.append_rows(rows(spark, ("4", d(2), "z", "z")), path, "day")
    assert len(got(spark, path)) == 3
    assert tables.delete_before(spark, path, "day", d(2)) == 1
    assert [r[0] for r in got(spark, path)] == ["3", "4"]


def test_ensure_recluster_migrate(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.ensure_table(spark, path, SCHEMA, "day") is True
    assert tables.ensure_table(spark, path, SCHEMA, "day") is False
    assert tables.read_table(spark, path, SCHEMA).count() == 0
    data = rows(spark, *[(str(i), d(1 + i % 3), f"a{i % 5}", "b") for i in range(40)])
    tables.write_partitioned(data, path, "day", ("id",))
    before = got(spark, path)
    assert tables.recluster(spark, path, "day", ("a", "id")) == 40
    assert got(spark, path) == before
    v2 = tables.backup_and_migrate(spark, path, "day", ("a",), 2)
    assert got(spark, v2) == before == got(spark, path)


def test_retention_cutoff_and_survivors(spark):
    assert tables.retention_cutoff(dt.date(2024, 2, 29), 2) == dt.date(2022, 2, 28)
    assert tables.retention_cutoff(dt.date(2024, 1, 16), 2) == dt.date(2022, 1, 16)
    kept = tables.survivors(rows(spark, ("1", d(1), "", ""), ("2", d(2), "", ""),
                                 ("3", None, "", "")), "day", d(2))
    assert sorted(r["id"] for r in kept.collect()) == ["2", "3"]


def test_layers_catalogue_and_layout(spark, tmp_path):
    assert tables.create_layers(spark, str(tmp_path)) == ["stage", "olap", "monitoring"]
    table = TABLES["fact_sessions"]
    path = str(tmp_path / "olap" / "fact_sessions")
    one = spark.range(3).select(F.lit(d(1)).alias("session_date"), F.col("id"))
    tables.write_partitioned(one, path, "session_date")
    name = tables.catalogue(spark, path, table)
    assert spark.table(name).count() == 3
    assert spark.catalog.getTable(name).description == table.description
    layout = [tuple(r) for r in tables.table_layout(spark, "fact_sessions").collect()]
    assert layout == [("fact_sessions", 1, "date_key"), ("fact_sessions", 2, "channel_key"),
                      ("fact_sessions", 3, "has_conversion")]
    spark.sql(f"DROP TABLE {name}")


def test_swap_keeps_the_version_before_and_recovers(spark, tmp_path):
    path, new = str(tmp_path / "t"), str(tmp_path / "new")
    for n in (1, 2, 3):
        tables.write_replace(spark.range(n), new)
        tables.swap_in(spark, new, path)
        assert spark.read.parquet(path).count() == n
    assert spark.read.parquet(f"{path}.old").count() == 2
    assert tables.recover(spark, path) is False
    (tmp_path / "t").rename(tmp_path / "lost")
    assert tables.recover(spark, path) is True
    assert spark.read.parquet(path).count() == 2
    tables.drop(spark, path)
    assert not tables.exists(spark, path)


def rows_read(df):
    """Rows that the plan's scan handed on."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_a_lookup_of_an_absent_id_reads_no_row(spark, tmp_path):
    """Ids lie between the least and greatest of every file, and are too many for dictionaries."""
    df = spark.range(60_000).select(F.concat(F.lit("u"), F.xxhash64("id")).alias("user"),
                                    F.lit(d(1)).alias("day"), F.col("id").alias("b"))
    for name, lookups in (("plain", ()), ("bloom", ("user",))):
        tables.write_partitioned(df, str(tmp_path / name), "day", ("b",), lookups=lookups)
    absent, there = F.col("user") == "u-1234567", F.col("user") == df.first()["user"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {n: spark.read.parquet(str(tmp_path / n)) for n in ("plain", "bloom")}
        assert rows_read(read["plain"].where(absent)) > 0 and rows_read(read["bloom"].where(absent)) == 0
        assert read["bloom"].where(there).count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_that_come_again_count_as_one_where_allowed(spark):
    target = rows(spark, ("1", d(1), "old", "old"))
    source = rows(spark, *[("1", d(1), "new", "new")] * 3, *[("2", d(1), "new", "new")] * 2)
    merged = merge.merge_rows(target, source, ["id", "day"], repeats=True)
    assert sorted(map(tuple, merged.collect())) == [("1", d(1), "new", "new"), ("2", d(1), "new", "new")]
