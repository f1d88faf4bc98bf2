"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words: a share by weight of a total, limited to a multiple of
the source's own size, what is cut off being shared out again by weight. Inside a source a
document's expected copies follow a preference by length class, scaled so that the source
meets its target and limited in the same way. The whole part of the expected copies is
certain. The rest is an inclusion probability p, and the documents are ranked by

    (u / (1 - u)) / (p / (1 - p)),   u uniform in (0, 1) from the document's id,

random odds over inclusion odds. The lowest ranks are taken until the sample has its fixed
size, counted in words; the document that crosses it is taken if that comes nearer.

Plan: one pass over the texts writes (id, source, size, u); all later steps work on that.
A source's ranking is never sorted as a whole. Ranks are counted in 4,096 cells per source,
the cell that holds the crossing is cut into 4,096 cells again, and only its last cell is
ordered row by row: of 10^10 documents of one source, about 600 rows. Sources meet in one
task with one row each.

Defined cases: a text that is null or without words has size 0 and takes 0 words; a null
source is a source of its own and comes last; a source of size 0 has target 0; rows that
repeat a doc_id share u and tie, equal rows are then interchangeable; a null doc_id is drawn
by its size; an empty table gives an empty result. Other columns are kept by
:func:`mix_rows` and not read by :func:`mix`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstar.llm.tables import Scratch

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MAX_COPIES = 2
# Least number of words and preference: longer documents are repeated a little more often.
PREFERENCE = ((1000, 4), (200, 3), (0, 2))
CELLS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def uniform(doc_id: Column, size: Column, seed: str) -> Column:
    """In (0, 1), with 48 random bits: the same on every run."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"),
                                                 F.concat(F.lit("null-"), size)))
    return (F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") + 0.5) / float(2 ** 48)


def water_fill(rows: DataFrame, group: list[str], total: Column) -> DataFrame:
    """Adds ``share``: ``total`` split by ``mass``, at most ``limit`` each, rest shared again.

    Rows fill up in the order of limit / mass. A row is full if it is so at the level that
    holds when all rows before it are full; ``order`` makes the order total.
    """
    w = Window.partitionBy(*group).orderBy(F.col("limit") / F.col("mass"), "order")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    tried = (rows.withColumn("rest", rest).withColumn("open", F.sum("mass").over(after))
             .withColumn("full", F.col("rest") * F.col("mass") > F.col("limit") * F.col("open")))
    # the first row that is not full sets the level for itself and all after it
    first = F.min(F.when(~F.col("full"), F.struct(
        F.col("limit") / F.col("mass"), "order", F.col("rest").alias("level_rest"),
        F.col("open").alias("level_open")))).over(Window.partitionBy(*group))
    return (tried.withColumn("level", first)
            .withColumn("share", F.when(F.col("full") | F.col("level").isNull(), F.col("limit"))
                        .otherwise(F.col("level.level_rest") * F.col("mass")
                                   / F.col("level.level_open")))
            .drop("rest", "open", "full", "level"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
            share: float = TOTAL_SHARE, copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) with each source's ``target``; weights repeat by code point order."""
    by_code_point = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(by_code_point)
    mass = F.element_at(F.array(*map(F.lit, weights)),
                        ((place - 1) % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", place.alias("order"), mass.alias("mass"),
                        (F.col("source_size") * F.lit(float(copies))).alias("limit"))
    everything = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    return water_fill(rows.withColumn("everything", everything), [], F.col("everything")).select(
        "source", "source_size", F.col("share").alias("target"))


def length_class(size: Column) -> Column:
    """The place of a document's preference in PREFERENCE; size 0 has none."""
    found = F.lit(None).cast("int")
    for place in reversed(range(len(PREFERENCE))):
        found = F.when(size >= max(1, PREFERENCE[place][0]), place).otherwise(found)
    return found


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


@dataclass(frozen=True)
class Decision:
    """What decides the copies of a row: tables of one row per source, or class of it, and the edge."""

    sources: DataFrame
    classes: DataFrame
    cuts: DataFrame
    edge: DataFrame

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source, size, u, class, ...) with ``whole`` copies and the ``side`` of their rank.

        A row before its source's edge cell (-1) gets one copy more, one behind it (1) does
        not, and one inside (0) is decided by the order of the ranks.
        """
        return beside(self.cuts, drawn(self.classes, rows))


def sized(docs: DataFrame, *others: str, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, u, class) of each row, and other columns."""
    size = n_words(F.col("text"))
    rows = docs.select("doc_id", "source", *others, size.alias("size"))
    return rows.withColumn("u", uniform(F.col("doc_id"), F.col("size"), seed)).withColumn(
        "class", length_class(F.col("size")))


def drawn(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds ``whole`` copies, ``rank`` and ``r``, the rank's place from 0 to 1."""
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    met = rows.join(classes, same(F.col("source"), F.col("s"))
                    & (F.col("class") == F.col("c")), "left")
    rank = F.when(F.col("p") > 0, odds)
    return met.select(*rows.columns, F.coalesce("whole", F.lit(0)).alias("whole"),
                      rank.alias("rank"), (rank / (1 + rank)).alias("r"))


def cell_of(r: Column) -> tuple[Column, Column]:
    """The outer cell of a rank's place, and the inner one in it."""
    cell = F.least(F.lit(CELLS - 1), F.floor(r * CELLS)).cast("int")
    return cell, F.least(F.lit(CELLS - 1), F.floor((r * CELLS - cell) * CELLS)).cast("int")


def beside(cuts: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds the ``side`` of the source's edge cell and the words ``left`` for it."""
    cell, inner = cell_of(F.col("r"))
    where, edge = F.struct(cell, inner), F.struct("cut_cell", "cut_inner")
    side = F.when(F.col("r").isNull() | F.col("cut_cell").isNull(), 1).when(
        where < edge, -1).when(where > edge, 1).otherwise(0)
    return rows.join(cuts.withColumnRenamed("s", "cut_source"), same(
        F.col("source"), F.col("cut_source")), "left").withColumn("side", side).select(
        *rows.columns, "side", "left")


def decide(slim: DataFrame, scratch: Scratch, weights: tuple[float, ...] = WEIGHTS,
           share: float = TOTAL_SHARE, copies: int = MAX_COPIES) -> Decision:
    """The decision over all rows of ``slim``, see :func:`sized`."""
    by_class = slim.groupBy("source", "class").agg(F.sum("size").alias("class_size"))
    sources = by_class.groupBy("source").agg(F.sum("class_size").alias("source_size"))
    sources = scratch.keep(targets(sources, weights, share, copies), "targets")
    preference = F.element_at(F.array(*[F.lit(float(p)) for _, p in PREFERENCE]),
                              F.col("class") + 1)
    classes = by_class.where("class IS NOT NULL").withColumnRenamed("source", "s")
    classes = classes.join(sources, same(F.col("s"), F.col("source"))).select(
        "source", "class", "class_size", "target", F.col("class").alias("order"),
        (F.col("class_size") * preference).alias("mass"),
        (F.col("class_size") * F.lit(float(copies))).alias("limit"))
    classes = water_fill(classes, ["source"], F.col("target"))
    expected = F.col("share") / F.col("class_size")
    # sums of doubles leave a hair below a whole number
    whole = F.floor(expected + 1e-9)
    p = F.greatest(F.lit(0.0), expected - whole)
    classes = scratch.keep(classes.select(
        F.col("source").alias("s"), F.col("class").alias("c"), whole.alias("whole"),
        F.when(p > 1e-9, p).otherwise(0.0).alias("p"), "class_size"), "classes")
    ranked = scratch.keep(drawn(classes, slim), "drawn")
    wanted = classes.groupBy("s").agg(F.sum(F.col("p") * F.col("class_size")).alias("words"))
    cuts = edge_cells(ranked, wanted, scratch)
    in_order = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    upto = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    nearer = upto - F.col("size") / 2 <= F.col("left")
    inside = beside(cuts, ranked).where("side = 0").select(
        "doc_id", "source", "size", "u", "whole", nearer.cast("int").alias("extra"))
    return Decision(sources, classes, cuts, scratch.keep(inside, "edge"))


def mix(docs: DataFrame, scratch: Scratch, weights: tuple[float, ...] = WEIGHTS,
        share: float = TOTAL_SHARE, copies: int = MAX_COPIES, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, u, source_size, target, copies) for each row of ``docs``."""
    slim = scratch.keep(sized(docs, seed=seed), "sizes")
    made = decide(slim, scratch, weights, share, copies)
    columns = ["doc_id", "source", "size", "u", "whole"]
    clear = made.placed(slim).where("side <> 0").select(
        *columns, (F.col("side") < 0).cast("int").alias("extra"))
    chosen = clear.unionByName(made.edge)
    return (chosen.join(made.sources.withColumnRenamed("source", "s"),
                        same(F.col("source"), F.col("s")))
            .select("doc_id", "source", "size", "u", "source_size", "target",
                    (F.col("whole") + F.col("extra")).alias("copies")))


def edge_cells(ranked: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """(s, cut_cell, cut_inner, left): where the lowest ranks of each source reach its ``words``."""
    cell, inner = cell_of(F.col("r"))
    some = ranked.where("r IS NOT NULL").select("source", "size", cell.alias("cell"),
                                                inner.alias("inner"))
    cells = scratch.keep(some.groupBy("source", "cell", "inner")
                         .agg(F.sum("size").alias("words")), "cells")
    left = wanted.withColumnRenamed("words", "left")
    outer = crossing(cells.groupBy("source", "cell").agg(F.sum("words").alias("words")),
                     left, "cell")
    within = cells.join(outer.select(F.col("s").alias("s1"), F.col("at").alias("c1"), "left"),
                        same(F.col("source"), F.col("s1")) & (F.col("cell") == F.col("c1")))
    within = within.select("source", "inner", "words", "left")
    final = crossing(within.select("source", "inner", "words"),
                     within.groupBy(F.col("source").alias("s")).agg(F.first("left").alias("left")),
                     "inner")
    return scratch.keep(
        outer.select("s", F.col("at").alias("cut_cell")).join(
            final.select(F.col("s").alias("s2"), F.col("at").alias("cut_inner"), "left"),
            same(F.col("s"), F.col("s2")), "left").drop("s2"), "cuts")


def crossing(cells: DataFrame, wanted: DataFrame, at: str) -> DataFrame:
    """For each source the cell in which the running sum of words reaches ``left``.

    Beyond the last cell if the sum never does; ``left`` is what is still wanted there.
    """
    w = Window.partitionBy("source").orderBy(at)
    both = cells.join(wanted, same(F.col("source"), F.col("s")))
    upto = F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, 0))
    last = F.lead(at).over(w).isNull()
    both = both.withColumn("upto", upto).withColumn("last", last)
    reached = both.where((F.col("upto") >= F.col("left")) | F.col("last"))
    return reached.groupBy("s").agg(F.min(F.struct(
        F.col(at).alias("at"), (F.col("left") - (F.col("upto") - F.col("words"))).alias("left")))
        .alias("x")).select("s", "x.at", "x.left")


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs`` repeated as often as ``mixed`` takes them, columns unchanged.

    Joined by (doc_id, source, size). Rows that agree in all three share their copies: each
    gets the whole part, and the first ones in the order of their texts one more.
    """
    key = ["doc_id", "source", "size"]
    taken = mixed.groupBy(*key).agg(F.sum("copies").alias("_mix_copies"),
                                    F.count("*").alias("_mix_rows"))
    taken = taken.select(*[F.col(k).alias(f"_mix_{k}") for k in key], "_mix_copies", "_mix_rows")
    sized = docs.withColumn("_mix_words", n_words(F.col("text")))
    joined = sized.join(taken, same(F.col("doc_id"), F.col("_mix_doc_id"))
                        & same(F.col("source"), F.col("_mix_source"))
                        & (F.col("_mix_words") == F.col("_mix_size")))
    repeated = joined.where("_mix_rows = 1").withColumn("_mix_times", F.col("_mix_copies"))
    if not taken.where("_mix_rows > 1").isEmpty():
        place = F.row_number().over(Window.partitionBy(
            "_mix_doc_id", "_mix_source", "_mix_size").orderBy("text"))
        spread = F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + (
            place <= F.col("_mix_copies") % F.col("_mix_rows")).cast("int")
        repeated = repeated.unionByName(
            joined.where("_mix_rows > 1").withColumn("_mix_times", spread))
    return repeated.where("_mix_times > 0").withColumn("_mix_copy", F.explode(F.sequence(
        F.lit(1), F.col("_mix_times").cast("int")))).select(*docs.columns)


def mix_rows(docs: DataFrame, scratch: Scratch, **how) -> DataFrame:
    """The rows of ``docs`` repeated as often as :func:`mix` takes them, columns unchanged.

    A row's copies follow from its own size and number and from its source's few decision rows, so
    texts are read in place; only rows of an edge cell are looked up by (doc_id, source, size).
    Those that agree in all three share their copies: the first ones in the order of their
    texts get one more.
    """
    made = decide(scratch.keep(sized(docs), "sizes"), scratch, **how)
    key = ["doc_id", "source", "size"]
    edge = scratch.keep(made.edge.groupBy(*[F.col(k).alias(f"_mix_{k}") for k in key]).agg(
        F.sum("extra").alias("_mix_extra"), F.count("*").alias("_mix_rows")), "edge-keys")
    whole_row = F.struct(*[F.col(c) for c in docs.columns]).alias("_mix_row")
    rows = made.placed(sized(docs.select("doc_id", "source", "text", whole_row), "_mix_row"))
    found = rows.join(edge, (F.col("side") == 0) & same(F.col("doc_id"), F.col("_mix_doc_id"))
                      & same(F.col("source"), F.col("_mix_source"))
                      & (F.col("size") == F.col("_mix_size")), "left")
    extra = F.when(F.col("side") == 0, F.col("_mix_extra")).otherwise(
        (F.col("side") < 0).cast("int"))
    several = F.coalesce(F.col("_mix_rows") > 1, F.lit(False))
    taken = found.where(~several).select("_mix_row", (F.col("whole") + extra).alias("_mix_times"))
    if not edge.where("_mix_rows > 1").isEmpty():
        place = F.row_number().over(Window.partitionBy(
            "_mix_doc_id", "_mix_source", "_mix_size").orderBy("_mix_row.text"))
        spread = F.floor(F.col("_mix_extra") / F.col("_mix_rows")) + (
            place <= F.col("_mix_extra") % F.col("_mix_rows")).cast("int")
        taken = taken.unionByName(found.where(several).select(
            "_mix_row", (F.col("whole") + spread).alias("_mix_times")))
    return taken.where("_mix_times > 0").select("_mix_row", F.explode(F.sequence(
        F.lit(1), F.col("_mix_times").cast("int"))).alias("_mix_copy")).select(
        *[F.col("_mix_row").getField(c).alias(c) for c in docs.columns])
