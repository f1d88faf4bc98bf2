"""The daily rollup: merging over days, NULL members, sketch errors, what tiles read."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickstar.operators import metrics, rollup
from clickstar.plans.registry import QUERIES

MART = ("session_date date, user_pseudo_id string, channel_group string, channel_type string, "
        "device_category string, operating_system string, country string, region string, city string, "
        "utm_campaign string, utm_source string, utm_medium string, landing_page string, "
        "conversions bigint, leads bigint, engaged_sessions bigint, total_conversion_value double, "
        "session_duration_seconds bigint")


def mart(spark, n, users):
    rng = random.Random(n)
    pick = lambda *v: rng.choice([*v, None])
    return spark.createDataFrame([
        (dt.date(2024, 1, 1 + rng.randrange(5)), f"u{rng.randrange(users)}", pick("a", "b"), pick("x"),
         pick("d"), pick("o", "p"), pick("c"), pick("r"), pick("s", "t"), pick("k"), pick("l"), pick("m"),
         pick("/1", "/2", "/3"), rng.randrange(2), rng.randrange(2), rng.randrange(2),
         rng.choice([None, 1.25]), rng.choice([None, rng.randrange(4000)])) for _ in range(n)], MART)


def plain(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


NAMES = ["sessions", "conversions", "leads", "conversion_rate", "bounce_rate", "revenue_per_session",
         "avg_duration_min", "total_conversion_value"]


@pytest.mark.parametrize("tile_set,dims", [
    ("total", []), ("channel", ["channel_group"]), ("channel", ["session_date", "channel_type"]),
    ("place", ["city"]), ("place", ["country", "region", "city"]), ("page", ["landing_page"]),
    ("campaign", ["utm_source"]), ("device", ["operating_system"])])
def test_tiles_equal_the_mart(spark, tile_set, dims):
    rows = mart(spark, 500, 20)
    got = rollup.tile(rollup.daily_rollup(rows), tile_set, dims, *NAMES)
    assert plain(got) == plain(metrics.by(rows, dims, *NAMES))


def test_null_members_are_not_the_total(spark):
    rows = mart(spark, 60, 5).withColumn("landing_page", F.lit(None).cast("string"))
    kinds = rollup.daily_rollup(rows).groupBy("tile_set").agg(F.sum("sessions").alias("n")).collect()
    assert {r.tile_set: r.n for r in kinds} == dict.fromkeys(rollup.SETS, 60)
    assert rollup.tile(rollup.daily_rollup(rows.where("false")), "page", ["landing_page"], *NAMES).collect() == []


def test_estimates_stay_within_their_error(spark):
    rows = spark.range(60_000).select(
        (F.lit(dt.date(2024, 1, 1)) + (F.col("id") % 20).cast("int")).alias("session_date"),
        F.concat(F.lit("u"), F.xxhash64("id") % 25_000).alias("user_pseudo_id"),
        *[F.lit("x").alias(c) for c in rollup.DIMENSIONS], *[F.lit(1).alias(c) for c in rollup.SUMS],
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(10_000)).alias("session_duration_seconds"))
    one = rollup.daily_rollup(rows)
    users = rows.select("user_pseudo_id").distinct().count()
    got = rollup.tile(one, "total", [], "approx_users").first()[0]
    assert abs(got - users) <= 4 * rollup.USERS_ERROR * users
    p50, p90 = rollup.length_percentiles(one, "total", []).first()
    assert abs(p50 - 5000) <= 10_000 * 2 * rollup.RANK_ERROR and abs(p90 - 9000) <= 10_000 * 2 * rollup.RANK_ERROR


def test_tiles_scan_the_rollup_and_only_their_days(w):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for name in ("channel_rates_rolled", "top_cities_rolled", "kpi_overview_rolled"):
        text = plan(QUERIES[name](w))
        assert text.count("FileScan") == 1 and "tile_set" in text and "Join" not in text, name
    assert "PartitionFilters: [isnotnull(session_date" in plan(QUERIES["sessions_by_date_rolled"](w))
    made = plan(rollup.daily_rollup(w.mart_sessions()))
    assert made.count("Exchange hashpartitioning") == 1
