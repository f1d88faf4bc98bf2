"""Plans: pruning, shuffles, join strategies, generated code."""

import datetime as dt

import pytest

from clickstar.operators import facts, metrics, stage
from clickstar.plans.registry import QUERIES
from clickstar.sources import raw


@pytest.fixture(autouse=True)
def whole_filters(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flatten_is_one_generated_pass_without_shuffle(w):
    text = plan(stage.flatten(w.export))
    assert "Exchange" not in text and "ArrayFilter" not in text and "lambda" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_scans_prune_partitions_and_columns(w):
    text = plan(raw.scan_raw_day(w.export, dt.date(2024, 1, 15)).select("event_name"))
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "ReadSchema: struct<event_name:string>" in text
    text = plan(QUERIES["scan_lookback"](w))
    assert "PartitionFilters: [isnotnull(event_date_partition" in text


def test_cluster_filters_reach_the_scan(w):
    text = plan(QUERIES["lookup_examples"](w))
    assert "EqualTo(event_name,page_view)" in text and "EqualTo(user_pseudo_id,u7)" in text


@pytest.mark.parametrize("name,joins", [
    ("fact_sessions_conformed", 4), ("fact_events_conformed", 5), ("mart_sessions_conformed", 5),
    ("mart_conversions_conformed", 6)])
def test_small_written_dimensions_are_broadcast_and_facts_not_shuffled(w, name, joins):
    text = plan(QUERIES[name](w))
    assert text.count("BroadcastHashJoin") == joins
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def test_large_dimensions_are_not_broadcast(w, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(facts.fact_sessions(w.table("stg_sessions"), w.dims(True), True))
        assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sessions_aggregate_before_the_shuffle(w):
    for form in (stage.sessions_lite(w.flat), stage.sessions(w.table("stg_events_flat"))):
        text = plan(form)
        before = text[text.rindex("Exchange hashpartitioning"):]
        assert "functions=[partial_" in before
    assert plan(stage.sessions_lite(w.flat)).count("Exchange hashpartitioning") == 1


def test_numbering_shuffles_rows_once_by_slot(w):
    text = plan(facts.numbered_conversions(w.table("stg_events_flat")))
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 3 and all("_slot" in line or "ENSURE" in line for line in moved)
    assert sum("_slot" in line for line in moved) == 2 and "SinglePartition" not in text


def test_look_back_of_the_trend_prunes_partitions(w):
    text = plan(QUERIES["volume_trend"](w))
    assert "PartitionFilters: [isnotnull(session_date" in text


def test_dashboard_reads_needed_columns_only(w):
    text = plan(metrics.sessions_by_channel(w.mart_sessions()))
    fact = next(line for line in text.splitlines() if "session_engaged" in line or
                "has_conversion" in line and "FileScan" in line)
    assert "landing_page" not in fact


def test_date_filter_on_a_mart_prunes_the_fact(w):
    text = plan(metrics.sessions_by_date(metrics.since(w.mart_sessions(), dt.date(2024, 1, 10))))
    assert "PartitionFilters: [isnotnull(session_date" in text


def test_no_query_uses_python_workers_or_a_cross_join(w):
    for name in ("stg_sessions", "stg_users", "fact_events", "mart_sessions", "gap_sessions",
                 "conversion_number_lifetime", "volume_trend", "dim_channel"):
        text = plan(QUERIES[name](w))
        assert "EvalPython" not in text and "CartesianProduct" not in text, name


def test_wide_session_rows_are_shuffled_once(w):
    for form in (stage.sessions(w.table("stg_events_flat")),
                 stage.sessions_conformed(w.table("stg_events_flat"))):
        text = plan(form)
        assert text.count("Exchange hashpartitioning") == 1 and "functions=[partial_" in text


def test_scanning_tasks_of_the_warehouse_read_little(w, spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(4_000_000).selectExpr("xxhash64(id) AS x").coalesce(1).write.parquet(path)
    assert spark.read.parquet(path).rdd.getNumPartitions() >= 4
    assert w.spark.conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold") == "4096"


def test_estimates_are_checked_without_collecting_lengths(w):
    text = plan(QUERIES["rollup_estimates"](w))
    assert "collect_list" not in text and "sort_array" not in text
