"""License scan by ordered signature rules with a keyword prefilter.

Each text is normalised once to words. The words of a text that are keywords of some rule
select the rules to try; a text without keywords tries none. A rule's matches become
detections with a span of words. A detection is suppressed if its span lies inside another
one's of higher priority, or of equal priority and greater length (then: earlier rule).
All of it is a projection over the texts: no shuffle, and the rules travel as a literal.

Base phrases are rules with a fixed label; every place where their words stand one after
another counts, also inside other detections, and their labels are always reported.

Defined cases: a null or empty text has no words, no labels and score 0; rows are
independent, so repeated rows repeat their result; a very long text is read whole, in time close
to linear in its matches; equal spans of one priority go to the earlier rule; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import json
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.llm.license_rules import BASE, rules

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RULE = "array<struct<rule:int,priority:int,label:string,keyword:string,pattern:string>>"
DETECTIONS = "array<struct<first:int,last:int,priority:int,rule:int,label:string>>"
# Long arrays are folded in runs of so many items: a fold that appends copies its array each time.
RUN = 256
# A detection's part of the score: the priority of the best one, as a share of this.
FULL_SCORE = 100.0


@lru_cache(1)
def rule_list() -> list[dict]:
    return rules()


def normalised(text: Column) -> Column:
    """`` word word ... `` in lower case, or one blank without words."""
    return F.lower(F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")),
                                    SEPARATORS, " "))


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def runs(items: Column) -> Column:
    """An array's items in runs of RUN; an empty array has none."""
    last = F.floor((F.size(items) - 1) / F.lit(RUN)).cast("int")
    return F.when(F.size(items) == 0, F.array()).otherwise(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice(items, i * RUN + 1, F.lit(RUN))))


def folded(items: Column, carry: Column, kept_type: str, step) -> Column:
    """The array that a fold over ``items`` keeps; ``step(carry, item)`` gives (carry, array to add).

    Runs are folded one by one and their arrays joined at the end, so that the work stays close to
    linear in the number of items.
    """
    nothing = F.array().cast(f"array<{kept_type}>")

    def one(state: Column, item: Column) -> Column:
        carried, added = step(state.carry, item)
        return F.struct(carried.alias("carry"), F.concat(state.kept, added).alias("kept"))

    def run(state: Column, part: Column) -> Column:
        return bound(F.aggregate(part, F.struct(state.carry.alias("carry"), nothing.alias("kept")), one),
                     lambda r: F.struct(r.carry.alias("carry"),
                                        F.concat(state.runs, F.array(r.kept)).alias("runs")))

    start = F.struct(carry.alias("carry"), F.array().cast(f"array<array<{kept_type}>>").alias("runs"))
    return F.flatten(F.aggregate(runs(items), start, run).runs)


def matches(norm: Column, pattern: Column) -> Column:
    """(first, last) word of each match, in order."""
    def step(at: Column, piece: Column) -> tuple[Column, Column]:
        # the text before a match ends with the blank before its first word
        first = at + blanks(piece.before) - 1
        last = first + blanks(piece.match)
        return last + 1, F.array(F.struct(first.alias("first"), last.alias("last")))

    def placed(found: Column) -> Column:
        pieces = F.zip_with(F.slice(F.split(norm, pattern, F.lit(-1)), 1, F.size(found)), found,
                            lambda b, m: F.struct(b.alias("before"), m.alias("match")))
        return F.when(F.size(found) == 0, F.array().cast("array<struct<first:int,last:int>>")
                      ).otherwise(bound(pieces, lambda all_pieces: folded(
                          all_pieces, F.lit(0), "struct<first:int,last:int>", step)))

    return bound(F.regexp_extract_all(norm, pattern, F.lit(0)), placed)


def keyword_hits(words: Column) -> Column:
    """The keywords of all rules that are among the text's words."""
    return F.array_intersect(words, F.array(*map(F.lit, sorted(
        {r["keyword"] for r in rule_list()}))))


def detections(norm: Column, hits: Column) -> Column:
    """All detections of the rules whose keyword is among ``hits``, a plain column."""
    table = F.from_json(F.lit(json.dumps(rule_list())), RULE)
    tried = F.filter(table, lambda r: F.array_contains(hits, r.keyword))
    found = F.flatten(F.transform(tried, lambda r: F.transform(
        matches(norm, r.pattern), lambda s: F.struct(
            s.first.alias("first"), s["last"].alias("last"), r.priority.alias("priority"),
            r.rule.alias("rule"), r.label.alias("label")))))
    return F.when(F.size(hits) == 0, F.array().cast(DETECTIONS)).otherwise(found)


def surviving(found: Column) -> Column:
    """The detections that no other one suppresses, sorted by start.

    From the same start the longest comes first, then the highest priority, then the earliest rule. So
    a span lies inside another one that outranks it only if, among those before it with at least
    its priority, the farthest end reaches its own: one pass that carries an end for each priority.
    """
    levels = sorted({r["priority"] for r in rule_list()})
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(
        d.first.alias("first"), (-d["last"]).alias("ends"), (-d.priority).alias("ranks"),
        d.rule.alias("rule"), d.label.alias("label"))))

    def step(far: Column, d: Column) -> tuple[Column, Column]:
        level = F.array_position(F.array(*map(F.lit, levels)), -d.ranks).cast("int")
        shown = F.struct(d.first.alias("first"), (-d.ends).alias("last"), (-d.ranks).alias("priority"),
                         d.rule.alias("rule"), d.label.alias("label"))
        stays = F.element_at(far, level) < -d.ends
        reach = F.transform(far, lambda end, i: F.when(i < level, F.greatest(end, -d.ends)).otherwise(end))
        return reach, F.when(stays, F.array(shown)).otherwise(F.array().cast(DETECTIONS))

    nowhere = F.array(*[F.lit(-1)] * len(levels))
    return bound(ordered, lambda d: folded(d, nowhere, DETECTIONS[6:-1], step))


def base_places(norm: Column) -> Column:
    """(first, label) of every place of a base phrase."""
    per_phrase = [F.when(norm.contains(f" {phrase} "), F.transform(
        matches(norm, F.lit(f"(?<= ){phrase}(?= )")),
        lambda s: F.struct(s.first.alias("first"), F.lit(label).alias("label")))).otherwise(
            F.array().cast("array<struct<first:int,label:string>>"))
        for phrase, label in BASE.items()]
    return F.flatten(F.array(*per_phrase))


def joined(labels: Column) -> Column:
    return F.array_join(F.sort_array(F.array_distinct(labels)), ",")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base_places, detections): the detections are the surviving ones."""
    norm = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    norm = norm.select("doc_id", "norm", keyword_hits(F.split(F.trim("norm"), " ")).alias("hits"))
    seen = norm.select("doc_id", F.greatest(blanks(F.col("norm")) - 1, F.lit(0))
                       .cast("bigint").alias("n_words"),
                       base_places(F.col("norm")).alias("base_places"),
                       detections(F.col("norm"), F.col("hits")).alias("found"))
    return seen.select("doc_id", "n_words", "base_places",
                       F.when(F.size("found") < 2, F.col("found"))
                       .otherwise(surviving(F.col("found"))).alias("detections"))


def report(scanned: DataFrame) -> DataFrame:
    """The digest of a scan: places, labels and score of each document."""
    base, found = F.col("base_places"), F.col("detections")
    starts = F.transform(base, lambda p: p.first.cast("bigint"))
    base_labels = F.transform(base, lambda p: p.label)
    labels = F.transform(found, lambda d: d.label)
    best = F.array_max(F.transform(found, lambda d: d.priority))
    score = F.greatest(F.coalesce(best, F.lit(0)) / FULL_SCORE,
                       F.when(F.size(base) > 0, 0.4).otherwise(0.0))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, labels)).alias("labels"), score.alias("score"))
