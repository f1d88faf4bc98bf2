"""Dashboard tiles from a daily rollup instead of the mart.

The rollup holds, per day and tile set, sums and sketches that merge over any days: one pass over
a day's mart rows makes all sets, and a tile over a year reads a year of rollup rows, not of
sessions. Counts, sums and rates are exact; distinct users come from HyperLogLog
sketches and percentiles of the session length from KLL sketches, within the errors stated below.
Tiles that combine dimensions of several sets, as free filters do, read the mart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.functions.rates import percent, ratio
from clickstar.operators.metrics import CAMPAIGN

SETS: dict[str, tuple[str, ...]] = {
    "total": (),
    "channel": ("channel_group", "channel_type"),
    "device": ("device_category", "operating_system"),
    "place": ("country", "region", "city"),
    "campaign": tuple(CAMPAIGN),
    "page": ("landing_page",),
}
DIMENSIONS = [c for dims in SETS.values() for c in dims]
SUMS = ["conversions", "leads", "engaged_sessions", "total_conversion_value"]
# Relative standard error of distinct users, and the largest usual error of a percentile's rank.
USERS_ERROR = 0.016
RANK_ERROR = 0.02


def _set_name() -> Column:
    """The tile set of a grouping set, from the columns it does not group by."""
    def number(dims: tuple[str, ...]) -> int:
        return sum(1 << (len(DIMENSIONS) - 1 - i) for i, c in enumerate(DIMENSIONS) if c not in dims)

    (first, dims), *rest = SETS.items()
    start = F.when(F.grouping_id() == number(dims), first)
    return reduce(lambda acc, s: acc.when(F.grouping_id() == number(s[1]), s[0]), rest, start)


def daily_rollup(mart: DataFrame) -> DataFrame:
    """(session_date, tile_set, dimensions, sums, sketches): one row per day and member of a set."""
    sets = [["session_date", *dims] for dims in SETS.values()]
    seconds = F.col("session_duration_seconds")
    grouped = mart.groupingSets(sets, "session_date", *DIMENSIONS).agg(
        _set_name().alias("tile_set"), F.count(F.lit(1)).alias("sessions"),
        *[F.sum(c).alias(c) for c in SUMS],
        F.sum(seconds).alias("seconds"), F.count(seconds).alias("timed"),
        F.hll_sketch_agg("user_pseudo_id", 12).alias("users"),
        F.kll_sketch_agg_bigint(seconds).alias("lengths"))
    return grouped.select("session_date", "tile_set", *DIMENSIONS, "sessions", *SUMS, "seconds",
                          "timed", "users", "lengths")


def measures(*names: str) -> list[Column]:
    """The dashboards' measures over rollup rows."""
    n, conv = F.sum("sessions"), F.sum("conversions")
    value = F.round(F.sum("total_conversion_value"), 4)
    known = {
        "sessions": n, "conversions": conv, "leads": F.sum("leads"),
        "engaged_sessions": F.sum("engaged_sessions"),
        "conversion_rate": F.round(percent(conv, n), 2),
        "lead_rate": F.round(percent(F.sum("leads"), n), 2),
        "engaged_rate": F.round(percent(F.sum("engaged_sessions"), n), 2),
        "bounce_rate": F.round(F.lit(100.0) - percent(F.sum("engaged_sessions"), n), 2),
        "revenue_per_session": F.round(ratio(value, n), 4),
        "avg_duration_min": F.round(ratio(F.sum("seconds"), F.sum("timed")) / 60, 4),
        "total_conversion_value": value,
        "approx_users": F.hll_sketch_estimate(F.hll_union_agg("users")),
    }
    return [known[name].alias(name) for name in names]


def tile(rollup: DataFrame, tile_set: str, dimensions: list[str], *names: str) -> DataFrame:
    """A tile over the rollup rows given; ``dimensions`` are days, months or columns of the set."""
    rows = rollup.where(F.col("tile_set") == tile_set)
    return rows.groupBy(*dimensions).agg(*measures(*names))


def length_percentiles(rollup: DataFrame, tile_set: str, dimensions: list[str],
                       shares: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """About the given percentiles of the session length in seconds."""
    rows = rollup.where((F.col("tile_set") == tile_set) & (F.col("timed") > 0))
    merged = rows.groupBy(*dimensions).agg(F.kll_merge_agg_bigint("lengths").alias("lengths"))
    return merged.select(*dimensions, *[
        F.kll_sketch_get_quantile_bigint("lengths", F.lit(s)).alias(f"p{round(s * 100)}_seconds")
        for s in shares])
