"""Each check with a passing and a failing case; alerts and reports at their limits."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar.operators import marts, metrics, monitor, quality
from clickstar.plans.registry import QUERIES
from clickstar.schemas import ETL_RUN_LOG


def d(n):
    return dt.date(2024, 1, n)


FLAT = "event_name string, user_pseudo_id string, event_timestamp bigint, ga_session_id bigint"
GOOD = [("page_view", "u", 1, 1)]
SESS = "session_id string, session_duration_seconds bigint, events_count bigint"
CASES = [
    ("stage_events_volume", FLAT, GOOD, []),
    ("stage_events_missing_session_id", FLAT, GOOD * 101 + [("x", "u", 1, None)],
     GOOD * 99 + [("x", "u", 1, None)]),
    ("stage_events_missing_session_id", FLAT, GOOD, []),
    ("stage_sessions_volume", SESS, [("s", 0, 1)], []),
    ("stage_sessions_negative_duration", SESS, [("s", 0, 1)], [("s", -1, 1)]),
    ("stage_sessions_events_distribution", SESS, [("s", 0, 1)], [("s", 0, 1001)]),
    ("stage_sessions_unique", SESS, [("s", 0, 1), ("t", 0, 1)], [("s", 0, 1), ("s", 0, 1)]),
    ("stage_sessions_unique", SESS, [("s", 0, 1)], [("s", 0, 1), (None, 0, 1)]),
    ("stage_events_critical_fields", FLAT, GOOD, [(None, "u", 1, 1)]),
    ("stage_events_critical_fields", FLAT, GOOD, [("x", None, 1, 1)]),
    ("stage_events_critical_fields", FLAT, GOOD, [("x", "u", None, 1)]),
    ("olap_fact_sessions_volume", SESS, [("s", 0, 1)], []),
    ("olap_dim_date_unique_keys", "date_key int", [(1,), (2,)], [(1,), (1,)]),
    ("olap_dim_device_unique_keys", "device_key string", [("a",)], [("a",), ("a",)]),
]


@pytest.mark.parametrize("name,schema,good,bad", CASES)
def test_check_passes_and_fails(spark, name, schema, good, bad):
    check = quality.CHECKS[name]
    for data, expected in ((good, "PASS"), (bad, "FAIL")):
        row = check.report(spark.createDataFrame(data, schema)).first()
        assert (row["assertion_name"], row["status"]) == (name, expected)


def test_single_row_has_no_deviation(spark):
    row = quality.CHECKS["stage_sessions_events_distribution"].report(
        spark.createDataFrame([("s", 0, 4)], SESS)).first()
    assert row["stddev_events_per_session"] is None and row["avg_events_per_session"] == 4


def test_orphans_count_nulls(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "device_key string")
    dim = spark.createDataFrame([("a",)], "device_key string")
    row = quality.integrity(fact, dim, "dim_device").first()
    assert (row["orphan_sessions"], row["status"]) == (2, "FAIL")
    assert quality.integrity(fact.where("device_key = 'a'"), dim,
                             "dim_device").first()["status"] == "PASS"


@pytest.mark.parametrize("facts,stage,status", [(10, 10, "PASS"), (15, 10, "PASS"),
                                                (16, 10, "FAIL"), (0, 6, "FAIL")])
def test_consistency(spark, facts, stage, status):
    assert quality.consistency(spark.range(facts), spark.range(stage)).first()["status"] == status


def test_dimensions_not_empty(spark):
    dims = {n: spark.range(1) for n in quality.REFERENCES}
    assert quality.not_empty(dims).first()["status"] == "PASS"
    dims["dim_geo"] = spark.range(0)
    row = quality.not_empty(dims).first()
    assert (row["dim_geo_count"], row["status"]) == (0, "FAIL")


@pytest.mark.parametrize("n,tolerance,minimum", [
    (89, "FAIL", "FAIL"), (90, "PASS", "FAIL"), (110, "PASS", "PASS"), (111, "FAIL", "PASS")])
def test_value_check_reads_both_ways(spark, n, tolerance, minimum):
    rows = {r["check_name"]: r for r in quality.value_checks(
        spark.range(n), spark.range(10), spark.range(10)).collect()}
    row = rows["check_events_volume"]
    assert (row["tolerance_status"], row["minimum_status"]) == (tolerance, minimum)


def test_gate_and_bad_amounts(spark):
    assert quality.truthy(spark.range(0), "g").first()["passed"] is False
    assert quality.truthy(spark.range(2), "g").first()["passed"] is True
    flat = spark.createDataFrame([("1.5",), ("x",), (None,)], "conversion_value string")
    row = quality.bad_amounts(flat).first()
    assert (row["unreadable_values"], row["status"]) == (1, "FAIL")


def volumes(spark, *pairs):
    data = [(d(day),) for day, n in pairs for _ in range(n)]
    return spark.createDataFrame(data, "event_date_partition date")


def test_volume_drop(spark):
    rows = {r["check_date"]: r for r in monitor.volume_changes(
        volumes(spark, (1, 10), (2, 8), (3, 6), (5, 1))).collect()}
    assert rows[d(1)]["status"] == "PASS" and rows[d(1)]["previous_count"] is None
    assert rows[d(2)]["status"] == "PASS" and rows[d(2)]["pct_change"] == -20.0
    assert rows[d(3)]["status"] == "FAIL" and rows[d(3)]["pct_change"] == -25.0
    assert rows[d(5)]["previous_count"] is None and rows[d(5)]["status"] == "PASS"
    flat = volumes(spark, (1, 10))
    assert monitor.volume_drop(flat, d(2), d(1)).isEmpty()
    assert monitor.missing_daily_data(flat, d(2)).first()["status"] == "FAIL"
    assert monitor.missing_daily_data(flat, d(1)).first()["status"] == "PASS"


def run(day, dag, status, message=None, hour=1):
    return ("r", d(day), dag, "t", status, 10, 2_000_000_000, 5, message,
            dt.datetime(2024, 1, day, hour))


def test_health_and_failures(spark):
    log = spark.createDataFrame(
        [run(15, "a", "success"), run(15, "b", "failed", "m2"), run(15, "b", "failed", "m1", 2),
         run(15, "b", "failed", "m1", 3), run(14, "a", "failed"), run(13, "c", "failed"),
         run(14, "d", "running")], ETL_RUN_LOG)
    health = {r["dag_id"]: r["health_status"] for r in monitor.pipeline_health(
        log, d(16)).collect()}
    assert health == {"a": "HEALTHY", "b": "FAILED", "c": "STALE", "d": "HEALTHY"}
    row = monitor.failed_jobs(log, d(15)).first()
    assert (row["failed_tasks"], row["error_messages"]) == (3, "m1; m2")
    nothing = monitor.failed_jobs(log, d(14)).first()
    assert (nothing["failed_tasks"], nothing["error_messages"]) == (1, None)
    assert monitor.recent_runs(log, d(15)).count() == 4


def test_quality_alert(spark):
    log = spark.createDataFrame([(d(1), "PASS"), (d(1), "FAIL"), (d(2), "PASS")],
                                "check_date date, status string")
    bad = monitor.quality_failures(log, d(1)).first()
    assert (bad["failed_assertions"], bad["total_assertions"], bad["status"]) == (1, 2, "FAIL")
    assert monitor.quality_failures(log, d(2)).first()["status"] == "PASS"


QUERY = ("job_id string, creation_time timestamp, statement_type string, "
         "total_bytes_processed bigint, total_bytes_billed bigint, total_slot_ms bigint, "
         "query string")


def test_query_reports(spark):
    t = dt.datetime(2024, 1, 15, 1)
    text = "SELECT 1 FROM stg_events_flat WHERE event_date_partition = '2024-01-0{}'"
    data = [("a", t, "SELECT", 10 ** 12, 3 * 10 ** 12, 100, text.format(1)),
            ("b", t, "SELECT", 10 ** 12, 3 * 10 ** 12, 100, text.format(1)),
            ("c", t, "INSERT", 10 ** 9, 10 ** 12, 100, text.format(2)),
            ("d", t, "SELECT", 10 ** 8, 10 ** 8, 100, "SELECT 1")]
    q = spark.createDataFrame(data, QUERY)
    cost = monitor.high_query_cost(q, d(15)).first()
    assert (cost["high_cost_queries"], cost["total_tb_billed"]) == (2, 6.0)
    assert monitor.high_query_cost(q.where("job_id <> 'b'"), d(15)).isEmpty()
    assert [r[0] for r in monitor.expensive_queries(q, d(15)).collect()] == ["a", "b"]
    assert [r[0] for r in monitor.clustering_benefit(q, d(15)).collect()] == ["a", "b"]
    labels = {r["job_id"]: r[3] for r in monitor.clustering_labels(q, d(15)).collect()}
    assert labels == {"a": V.CLUSTERING_EFFECTIVE, "b": V.CLUSTERING_EFFECTIVE,
                      "d": V.CLUSTERING_NOT_EFFECTIVE}
    used = monitor.partitions_queried(q, d(15), "stg_events_flat").first()
    assert (used["query_count"], used["unique_partitions_queried"]) == (3, 2)
    perf = monitor.query_performance(q, d(15)).first()
    assert (perf["total_queries"], perf["large_queries"]) == (3, 2)
    assert monitor.costliest_queries(q, d(15), 1).first()["job_id"] == "a"


def test_partition_reports(spark):
    gb = 10 ** 9
    stats = spark.createDataFrame(
        [("t", "2024-01-01", 1, gb // 4), ("t", "2024-01-02", 1, gb),
         ("t", "2024-01-03", 1, 2 * gb), ("t", "2024-01-04", 1, 2 * gb + 10 ** 7)],
        "table_name string, partition_id string, total_rows bigint, total_logical_bytes bigint")
    advice = {r["partition_id"][-1]: r["recommendation"]
              for r in monitor.size_recommendation(stats).collect()}
    assert advice == {"1": V.PARTITION_TOO_SMALL, "2": V.PARTITION_OPTIMAL,
                      "3": V.PARTITION_OPTIMAL, "4": V.PARTITION_TOO_LARGE}
    assert [r["partition_id"] for r in monitor.large_partitions(stats).collect()] == ["2024-01-04"]
    assert monitor.large_partitions(stats, d(3)).isEmpty()
    assert [r[1] for r in monitor.newest_partitions(stats, 2).collect()] == [
        "2024-01-04", "2024-01-03"]
    assert monitor.partition_usage(stats).first()["num_partitions"] == 4


def test_file_stats_add_up(w):
    w.path("stg_events_flat")
    per_day = monitor.file_stats(w.spark, w.path("stg_events_flat"), "f", "event_date_partition")
    assert per_day.count() == 30
    assert per_day.agg(F.min("file_bytes")).first()[0] > 0


def test_file_bytes_equal_the_folder_listing(w):
    root, want = w.path("stg_events_flat").removeprefix("file:"), {}
    for folder, _, names in os.walk(root):
        sizes = [os.path.getsize(f"{folder}/{n}") for n in names if n.endswith(".parquet")]
        if sizes:
            want[os.path.basename(folder).split("=")[1]] = (len(sizes), sum(sizes))
    got = {r.partition_id: (r.files, r.file_bytes)
           for r in QUERIES["partition_file_bytes"](w).collect()}
    assert want and got == want


MART = ("session_date date, channel_group string, country string, device_category string, "
        "landing_page string, utm_campaign string, conversions bigint, leads bigint, "
        "engaged_sessions bigint, total_conversion_value double, session_duration_seconds bigint")


def mart(spark, *rows):
    return spark.createDataFrame(list(rows), MART)


def test_average_just_below_the_range_fails(spark):
    """The rule sees the average itself, not a rounded one."""
    few = spark.range(100_000).select(F.when(F.col("id") == 0, 0).otherwise(1).alias("events_count"))
    row = quality.CHECKS["stage_sessions_events_distribution"].report(few).first()
    assert row["status"] == "FAIL" and row["avg_events_per_session"] == 0.99999


def test_messages_stay_as_published_whatever_their_length(spark):
    """Long and short messages alike: distinct, whole, sorted."""
    messages = ["E1", "E2", "E1", None, "step stopped after 30 s", "step stopped after 60 s",
                "could not read row 1 of part 7", "could not read row 1 of part 7"]
    log = spark.createDataFrame([(d(15), "j", "failed", m) for m in messages],
                                "run_date date, dag_id string, status string, error_message string")
    row = monitor.failed_jobs(log, d(15)).first()
    assert (row["failed_tasks"], row["error_messages"]) == (
        8, "; ".join(sorted({m for m in messages if m})))
    assert monitor.failure_messages(log).count() == 6


def test_metrics_on_nothing_give_null_rates(spark):
    row = metrics.kpi_overview(mart(spark)).first()
    assert row["sessions"] == 0 and row["conversion_rate"] is None


def test_metrics_and_filters(spark):
    m = mart(spark,
             (d(1), "Social", "Spain", "mobile", "https://a.com/x", "c1", 1, 0, 1, 10.0, 120),
             (d(2), "Email", "Spain", "desktop", "https://b.org/x", "c1", 0, 1, 0, None, 60),
             (d(3), "Social", None, "mobile", None, V.UNKNOWN, 1, 0, 1, 5.0, 0))
    rates = {r["channel_group"]: r for r in metrics.rates(m, "channel_group").collect()}
    assert rates["Social"]["conversion_rate"] == 100.0 and rates["Social"]["bounce_rate"] == 0.0
    assert rates["Social"]["revenue_per_session"] == 7.5
    assert rates["Email"]["lead_rate"] == 100.0 and rates["Email"]["avg_duration_min"] == 1.0
    assert metrics.country_kpis(m).first()["top_country"] == "Spain"
    assert metrics.best_campaign(m, V.UNKNOWN).first()["utm_campaign"] == "c1"
    assert metrics.active_campaigns(m, V.UNKNOWN).first()[0] == 1
    assert metrics.mobile_vs_desktop(m).first()["mobile_sessions"] == 2
    funnel = [(r["step"], r["value"], r["step_rate"]) for r in metrics.channel_funnel(m).where(
        "channel_group = 'Email'").orderBy("step").collect()]
    assert funnel == [(1, 1, 100.0), (2, 0, 0.0), (3, 0, None)]
    assert metrics.apply_filters(m, d(2), d(3)).count() == 2
    assert metrics.apply_filters(m, channels=["Social"], countries=["Spain"]).count() == 1
    assert metrics.apply_filters(m, devices=["mobile"], contains={
        "landing_page": "a.com"}).count() == 1
    assert [r["landing_page"] for r in metrics.top_landing_pages(m, 2).collect()] == [
        None, "https://a.com/x"]


def test_region_filter_and_flags(spark):
    df = spark.createDataFrame([("r1", True), ("r2", None)], "region string, f boolean")
    assert marts.region_filter(df, "r1").count() == 1
    assert [r[0] for r in df.orderBy("region").select(marts.flag(F.col("f"))).collect()] == [1, 0]
