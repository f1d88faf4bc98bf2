"""Event funnels, page paths and cohort retention over whole histories of users.

A user or session may hold a third of all events. So each of these cuts it into time slots or
stretches of bounded length, reduces those in parallel to states that can be merged, and merges
the states: no event history is sorted or held as a whole.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstar import fixed_values as V
from clickstar.functions import rules
from clickstar.functions.rates import percent
from clickstar.operators.numbering import number_rows

MINUTE = 60_000_000
Steps = tuple[tuple[str, tuple[str, ...]], ...]
# From a visit to a sale; an event name belongs to one step only.
FUNNEL: Steps = (
    ("view", (V.PAGE_VIEW_EVENT, V.SCROLL_EVENT)),
    ("engagement", ("click", "file_download", "search")),
    ("lead", tuple(V.LEAD_EVENTS)),
    ("purchase", ("add_to_cart", "purchase", "conversion")),
)


# --- funnel ------------------------------------------------------------------------------


def step_number(steps: Steps) -> Column:
    """1 for an event of the first step, and so on; NULL for any other event."""
    names = [n for _, group in steps for n in group]
    if len(set(names)) < len(names):
        raise ValueError("an event name stands in two steps")
    return reduce(lambda acc, s: acc.when(F.col("event_name").isin(*s[1][1]), s[0]),
                  enumerate(steps, 1), F.when(F.lit(False), 0))


def event_channel() -> Column:
    """Channel group of the event itself."""
    source = F.coalesce("utm_source", "traffic_source_source", F.lit(V.UNKNOWN))
    medium = F.coalesce("utm_medium", "traffic_source_medium", F.lit(V.UNKNOWN))
    return rules.channel_group(source, medium)


class FunnelState:
    """What a stretch of a user's events means for a funnel of ``k`` steps in ``window`` micros.

    ``s1`` .. ``sk``: the latest start of a chain that matches steps 1 to j inside the stretch and the
    window; a later start can only be better. ``e_i_j``: the earliest time at which steps i + 1
    to j can be matched in a row, for chains that enter the stretch with i steps done. States
    of neighbouring stretches merge into the state of both.
    """

    def __init__(self, k: int, window: int) -> None:
        self.k, self.window = k, window
        self.starts = [f"s{j}" for j in range(1, k + 1)]
        self.pairs = list(combinations(range(1, k + 1), 2))

    def _struct(self, starts: dict[int, Column], ends: dict[tuple[int, int], Column]) -> Column:
        return F.struct(*[starts[j].cast("bigint").alias(f"s{j}") for j in range(1, self.k + 1)],
                        *[ends[p].cast("bigint").alias(f"e_{p[0]}_{p[1]}") for p in self.pairs])

    def empty(self) -> Column:
        none = F.lit(None)
        return self._struct({j: none for j in range(1, self.k + 1)}, {p: none for p in self.pairs})

    def after_event(self, state: Column, event: Column) -> Column:
        """The state once the next event (t, step) has passed."""
        t, step = event["t"], event["step"]
        starts = {1: F.when(step == 1, t).otherwise(state["s1"])}
        for j in range(2, self.k + 1):
            before = state[f"s{j - 1}"]
            starts[j] = F.when((step == j) & (t - before <= self.window),
                               F.greatest(state[f"s{j}"], before)).otherwise(state[f"s{j}"])
        ends = {}
        for i, j in self.pairs:
            old = state[f"e_{i}_{j}"]
            ready = F.lit(True) if i == j - 1 else state[f"e_{i}_{j - 1}"].isNotNull()
            ends[i, j] = F.when((step == j) & ready, F.coalesce(old, t)).otherwise(old)
        return self._struct(starts, ends)

    def merged(self, a: Column, b: Column) -> Column:
        """The state of stretch ``a`` and, after it, ``b``."""
        starts = {}
        for j in range(1, self.k + 1):
            crossing = [F.when(b[f"e_{i}_{j}"] - a[f"s{i}"] <= self.window, a[f"s{i}"])
                        for i in range(1, j)]
            starts[j] = F.greatest(a[f"s{j}"], b[f"s{j}"], *crossing)
        ends = {}
        for i, j in self.pairs:
            later = [b[f"e_{i}_{j}"]] + [F.when(a[f"e_{i}_{m}"].isNotNull(), b[f"e_{m}_{j}"])
                                         for m in range(i + 1, j)]
            ends[i, j] = F.coalesce(a[f"e_{i}_{j}"], F.least(*later) if len(later) > 1 else later[0])
        return self._struct(starts, ends)

    def folded(self, items: Column, merge) -> Column:
        return F.aggregate(items, self.empty(), merge)


def funnel_users(flat: DataFrame, steps: Steps = FUNNEL, window_minutes: int = 24 * 60,
                 slot_minutes: int = 15) -> DataFrame:
    """(user_pseudo_id, channel_group, s1 .. sk): sj is NULL where the user never reached step j.

    A step is reached by events of steps 1 to j in this order, ties by event id, with at most
    the window between the first and the last; other events may lie between. The channel is that of
    the user's first event of step 1. Events are folded per user and slot, slots per
    user; without a user or a time an event belongs to no funnel.
    """
    state = FunnelState(len(steps), window_minutes * MINUTE)
    events = flat.withColumn("step", step_number(steps)).where(
        "step IS NOT NULL AND user_pseudo_id IS NOT NULL AND event_timestamp IS NOT NULL").select(
        "user_pseudo_id", F.expr(f"(event_timestamp - pmod(event_timestamp, {slot_minutes * MINUTE}L)) "
                                 f"div {slot_minutes * MINUTE}L").alias("slot"),
        F.struct(F.col("event_timestamp").alias("t"), F.col("src_event_id").alias("id"),
                 "step").alias("event"),
        F.when(F.col("step") == 1, F.struct(F.col("event_timestamp").alias("t"),
                                            F.col("src_event_id").alias("id"),
                                            event_channel().alias("channel"))).alias("entry"))
    slots = events.groupBy("user_pseudo_id", "slot").agg(
        F.array_sort(F.collect_list("event")).alias("events"), F.min("entry").alias("entry"))
    slots = slots.select("user_pseudo_id", "entry", F.struct("slot", state.folded(
        F.col("events"), state.after_event).alias("state")).alias("part"))
    users = slots.groupBy("user_pseudo_id").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.min("entry").alias("entry"))
    whole = state.folded(F.transform("parts", lambda p: p["state"]), state.merged)
    return users.where("entry IS NOT NULL").select(
        "user_pseudo_id", F.col("entry.channel").alias("channel_group"), whole.alias("state")).select(
        "user_pseudo_id", "channel_group", "state.*").select(
        "user_pseudo_id", "channel_group", *state.starts)


def event_funnel(flat: DataFrame, steps: Steps = FUNNEL, window_minutes: int = 24 * 60,
                 slot_minutes: int = 15) -> DataFrame:
    """Users who reached each step per channel, with rates from the step before and from entry."""
    reached = funnel_users(flat, steps, window_minutes, slot_minutes).groupBy("channel_group").agg(
        *[F.count(f"s{j}").alias(f"s{j}") for j in range(1, len(steps) + 1)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(j).cast("bigint").alias("step"), F.lit(name).alias("step_name"),
                 F.col(f"s{j}").alias("users"), F.col(f"s{max(1, j - 1)}").alias("previous"),
                 F.col("s1").alias("entered")) for j, (name, _) in enumerate(steps, 1)]))
    return reached.select("channel_group", rows.alias("r")).select(
        "channel_group", "r.step", "r.step_name", "r.users",
        F.round(percent(F.col("r.users"), F.col("r.previous")), 2).alias("step_rate"),
        F.round(percent(F.col("r.users"), F.col("r.entered")), 2).alias("entry_rate"))


# --- paths -------------------------------------------------------------------------------

STRETCH = 1024


def page_grams(flat: DataFrame, n: int, stretch: int = STRETCH) -> DataFrame:
    """(session_id, pages): every n pages in a row that a session touched, reloads included.

    Pages are numbered in their session slot by slot. A session is then cut into stretches of
    ``stretch`` pages, each with the first n - 1 of the next one, so that no task
    sorts a whole session.
    """
    pages = flat.where("session_id IS NOT NULL AND page_location IS NOT NULL").select(
        "session_id", "page_location", "event_timestamp", "src_event_id")
    numbered = number_rows(pages, ["session_id"], "pos").select(
        "session_id", "page_location", (F.col("pos") - 1).alias("pos"))
    own = F.expr(f"pos div {stretch}")
    lent = (F.col("pos") % stretch < n - 1) & (F.col("pos") >= stretch)
    dealt = numbered.withColumn("own", own).select(
        "session_id", "page_location", "pos", "own", F.explode(F.when(
            lent, F.array("own", F.col("own") - 1)).otherwise(F.array("own"))).alias("part"))
    order = Window.partitionBy("session_id", "part").orderBy("pos")
    following = [F.lead("page_location", i).over(order) for i in range(1, n)]
    return dealt.withColumn("pages", F.array("page_location", *following)).where(
        (F.col("own") == F.col("part")) & F.col("pages")[n - 1].isNotNull()).select(
        "session_id", "pages")


def page_transitions(flat: DataFrame) -> DataFrame:
    """How often a page follows another in a session, and its share of all that follow that page."""
    pairs = page_grams(flat, 2).groupBy(F.col("pages")[0].alias("from_page"),
                                        F.col("pages")[1].alias("to_page")).agg(
        F.count(F.lit(1)).alias("transitions"))
    totals = pairs.groupBy("from_page").agg(F.sum("transitions").alias("total"))
    return pairs.join(totals, "from_page").select(
        "from_page", "to_page", "transitions",
        F.round(percent(F.col("transitions"), F.col("total")), 2).alias("share_of_from"))


# An item's count in the summary is off by at most this share of all items, over its size.
SUMMARY_ERROR = 3.5


def frequent(items: DataFrame, k: int, tracked: int = 10_000) -> DataFrame:
    """(item, n): the k most frequent strings of column ``item``, ties to the smaller one, exact.

    The first pass keeps a mergeable summary of at most ``tracked`` heavy hitters (Misra-Gries kind),
    so distinct items are not shuffled. The second pass counts its candidates exactly. What
    the summary let go is rarer than its error, so the answer stands if the k-th count is
    above that; on flat distributions, where it is not, all items are counted.
    """
    summary = items.agg(F.count("item").alias("n"), F.expr(
        f"approx_top_k(item, {tracked}, {tracked})").alias("top")).first()
    size = 1 << max(3, (tracked * 4 // 3).bit_length())
    error = SUMMARY_ERROR * summary["n"] / size
    best = [F.desc("n"), F.col("item")]
    spark = items.sparkSession
    candidates = spark.createDataFrame([(r["item"],) for r in summary["top"] or []], "item string")
    counted = items.join(F.broadcast(candidates), "item").groupBy("item").agg(
        F.count(F.lit(1)).alias("n")).orderBy(*best).limit(k).collect()
    if error < 1 or (len(counted) == k and counted[-1]["n"] > error):
        return spark.createDataFrame([tuple(r) for r in counted], "item string, n bigint")
    return items.where("item IS NOT NULL").groupBy("item").agg(
        F.count(F.lit(1)).alias("n")).orderBy(*best).limit(k)


def top_paths(flat: DataFrame, n: int = 3, k: int = 20, tracked: int = 10_000) -> DataFrame:
    """The k most frequent paths of n pages over all sessions."""
    paths = page_grams(flat, n).select(F.to_json("pages").alias("item"))
    return frequent(paths, k, tracked).select(
        F.array_join(F.from_json("item", "array<string>"), " > ").alias("path"),
        F.col("n").alias("occurrences"))


# --- cohorts -----------------------------------------------------------------------------

# Weeks are numbered from this Monday; a word of a user's bitmap holds so many.
FIRST_MONDAY = dt.date(1969, 12, 29)
WORD_WEEKS = 52


def week_number(day: Column) -> Column:
    days = F.datediff(day, F.lit(FIRST_MONDAY))
    return F.floor((days - F.pmod(days, F.lit(7))) / 7).cast("int")


def user_weeks(sessions: DataFrame) -> DataFrame:
    """(user_pseudo_id, word, weeks): bit i of word w is set if the user was active in week 52 w + i.

    Bitmaps of the days or files of a table merge by :func:`merged_weeks`, in any order.
    Without a user or a day a session counts for nobody.
    """
    known = sessions.where("user_pseudo_id IS NOT NULL AND session_date IS NOT NULL")
    bit = F.pmod("week", F.lit(WORD_WEEKS))
    marked = known.select("user_pseudo_id", week_number(F.col("session_date")).alias("week")).select(
        "user_pseudo_id", F.expr(f"(week - pmod(week, {WORD_WEEKS})) div {WORD_WEEKS}").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("weeks"))
    return merged_weeks(marked)


def merged_weeks(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user_pseudo_id", "word").agg(F.bit_or("weeks").alias("weeks"))


def cohort_retention(weeks: DataFrame) -> DataFrame:
    """Users by the week of their first activity and the weeks since, as a triangle.

    A user's words, one for each year with activity, meet in one row; weeks are counted in part before
    the triangle's few cells are shuffled.
    """
    lowest = F.bit_count(F.expr("~weeks & (weeks - 1)"))
    users = weeks.groupBy("user_pseudo_id").agg(
        F.min(F.col("word") * WORD_WEEKS + lowest).alias("first"),
        F.collect_list(F.struct("word", "weeks")).alias("words"))
    bits = F.sequence(F.lit(0), F.lit(WORD_WEEKS - 1))
    active = F.transform(F.filter(bits, lambda i: F.getbit("w.weeks", i) == 1),
                         lambda i: F.col("w.word") * WORD_WEEKS + i - F.col("first"))
    cells = users.select("first", F.explode("words").alias("w")).select(
        "first", F.explode(active).alias("since")).groupBy("first", "since").agg(
        F.count(F.lit(1)).alias("active_users"))
    cohort = Window.partitionBy("first").orderBy("since")
    return cells.withColumn("cohort_users", F.first("active_users").over(cohort)).select(
        F.date_add(F.lit(FIRST_MONDAY), (F.col("first") * 7).cast("int")).alias("cohort_week"),
        F.col("since").cast("bigint").alias("weeks_since"), "active_users", "cohort_users",
        F.round(percent(F.col("active_users"), F.col("cohort_users")), 2).alias("retention"))
