"""Each branch of the rule tables, NULLs and the order of rules."""

import pytest
from pyspark.sql import functions as F

from clickstar.functions import event_params as ep
from clickstar.functions import keys, rates, rules

CHANNELS = [
    ("google", "organic", "Organic Search", "Organic"),
    ("yahoo", "organic", "Organic Search", "Organic"),
    ("duck", "organic", "Other", "Organic"),
    ("x", "cpc", "Paid Search", "Paid"),
    ("x", "ppc", "Paid Search", "Paid"),
    ("x", "paidsearch", "Paid Search", "Paid"),
    ("google", "my-cpc-ad", "Paid Search", "Other"),
    ("yahoo", "my-cpc-ad", "Other", "Other"),
    ("x", "social", "Social", "Social"),
    ("x", "social-network", "Social", "Social"),
    ("x", "social-media", "Social", "Other"),
    ("x", "sm", "Social", "Other"),
    ("x", "social advertising", "Social", "Other"),
    ("facebook", "email", "Social", "Email"),
    ("tiktok", None, "Social", "Other"),
    ("facebook", "cpc", "Paid Search", "Paid"),
    ("x", "email", "Email", "Email"),
    ("(direct)", "(none)", "Direct", "Other"),
    ("(direct)", "(not set)", "Direct", "Other"),
    ("(direct)", "x", "Other", "Other"),
    ("x", "referral", "Referral", "Referral"),
    ("x", "display", "Display", "Display"),
    ("x", "banner", "Display", "Display"),
    ("x", "cpm", "Display", "Other"),
    (None, "cpm", "Display", "Other"),
    ("Google", "Organic", "Other", "Other"),
    (None, None, "Other", "Other"),
]


def column(spark, value, expr):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr(F.col("x"))).first()[0]


def test_channels(spark):
    df = spark.createDataFrame([(s, m, g, t) for s, m, g, t in CHANNELS],
                               "source string, medium string, g string, t string")
    got = df.select("source", "medium", "g", "t",
                    rules.channel_group(F.col("source"), F.col("medium")).alias("group"),
                    rules.channel_type(F.col("medium")).alias("type")).collect()
    for r in got:
        assert (r["group"], r["type"]) == (r["g"], r["t"]), r


@pytest.mark.parametrize("name,category", [
    ("page_view", "View"), ("view_item_list", "View"), ("click", "Engagement"),
    ("select_content", "Engagement"), ("contact", "Lead"), ("purchase", "Conversion"),
    ("begin_checkout", "Conversion"), ("search", "Search"), ("scroll", "Engagement"),
    ("video_progress", "Engagement"), ("exception", "Other"), (None, "Other")])
def test_event_category(spark, name, category):
    assert column(spark, name, rules.event_category) == category


@pytest.mark.parametrize("name,conversion,lead", [
    ("purchase", True, False), ("conversion", True, False), ("generate_lead", True, True),
    ("form_submit", False, True), ("contact", False, True), ("scroll", False, False),
    (None, False, False)])
def test_event_flags(spark, name, conversion, lead):
    assert column(spark, name, rules.is_conversion) is conversion
    assert column(spark, name, rules.is_lead) is lead


@pytest.mark.parametrize("country,group", [
    ("Mexico", "North America"), ("Chile", "Latin America"), ("Italy", "Europe"),
    ("South Korea", "Asia"), ("Kenya", "Other"), (None, "Other")])
def test_region_group(spark, country, group):
    assert column(spark, country, rules.region_group) == group


@pytest.mark.parametrize("category,kind", [
    ("mobile", "Mobile"), ("tablet", "Tablet"), ("desktop", "Desktop"), ("smart tv", "Other"),
    (None, "Other")])
def test_device_type(spark, category, kind):
    assert column(spark, category, rules.device_type) == kind


@pytest.mark.parametrize("url,host", [
    ("https://www.a.com/p1", "www.a.com"), ("http://b.org", "b.org"),
    ("see https://c.net/x", "c.net"), ("app://home", None), ("", None), (None, None)])
def test_page_domain(spark, url, host):
    assert column(spark, url, rules.page_domain) == host


def test_keys(spark):
    import hashlib

    one = spark.range(1).select(
        keys.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit("c")).alias("k"),
        keys.session_key(F.lit("u1"), F.lit(5)).alias("s"),
        keys.session_key(F.lit("u1"), F.lit(None).cast("bigint")).alias("none"),
        keys.session_key(F.lit(None).cast("string"), F.lit(5)).alias("nobody"),
        keys.utc_text(F.lit("2024-01-15").cast("timestamp")).alias("t")).first()
    assert one["k"] == hashlib.sha256(b"a|unknown|c").hexdigest()
    assert (one["s"], one["none"], one["nobody"]) == ("u1_5", None, None)
    assert one["t"] == "2024-01-15 00:00:00+00"


def test_event_param_takes_the_first_of_two_and_null_when_absent(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (array(named_struct('key','a','value',named_struct('string_value','x','int_value',1L,
          'double_value',0.5D)), named_struct('key','a','value',named_struct('string_value','y',
          'int_value',2L,'double_value',1.5D)))),
        (array()), (NULL) AS t(event_params)""")
    got = df.select(ep.event_param("a", "string_value").alias("s"),
                    ep.event_param_typed("a", "int").alias("i"),
                    ep.event_param_typed("a", "double").alias("d"),
                    ep.event_param_typed("a", "string").alias("t"),
                    ep.event_param("b", "string_value").alias("no"),
                    ep.has_duplicate_keys().alias("dup")).collect()
    assert tuple(got[0]) == ("x", "1", "0.5", "x", None, True)
    assert tuple(got[1])[:5] == (None,) * 5 and got[1]["dup"] is False
    assert tuple(got[2])[:5] == (None,) * 5


def test_rates_give_null_on_zero(spark):
    one = spark.range(1).select(rates.percent(F.lit(1), F.lit(0)).alias("z"),
                                rates.percent(F.lit(1), F.lit(4)).alias("q")).first()
    assert (one["z"], one["q"]) == (None, 25.0)
