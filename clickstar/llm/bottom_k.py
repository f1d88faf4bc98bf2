"""Bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k smallest 64-bit hashes of a text's distinct shingles
of five words (case and white space do not count; a shorter text is one shingle of all its
words). Sketches of parts merge into the sketch of the whole, and two sketches estimate
resemblance, containment and the number of distinct shingles.

Defined cases: a text that is null or has no words has an empty sketch; two empty sketches
resemble each other fully, an empty and another one not at all; below k shingles all
estimates are exact (up to equal hashes). Other columns pass through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstar.llm.tables import Scratch

K = 128
WIDTH = 5
SPAN = float(2 ** 64)


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The bottom-k sketch of a text."""
    trimmed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(
        _of_words(F.split(trimmed, r"\s+"), k, width))


def _of_words(words: Column, k: int, width: int) -> Column:
    # the word hashes are bound once by a lambda, so each shingle reads five longs
    def shingles(h: Column) -> Column:
        spans = F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(
            *[F.get(h, i + j) for j in range(width)]))
        return F.when(F.size(h) < width, F.array(F.xxhash64(h))).otherwise(spans)

    hashed = F.array(F.transform(words, lambda w: F.xxhash64(w)))
    return smallest(F.get(F.transform(hashed, shingles), 0), k)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(left: Column, right: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return smallest(F.concat(left, right), k)


def merge_all(sketches: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """One sketch per ``key``.

    Only the k smallest of all hashes matter, so each is cut to its place among the key's
    distinct hashes; a key's hashes are first spread over 256 sub-groups and cut there, so
    that a key with most rows meets as 256 x k hashes at most.
    """
    rows = sketches.select(key, F.explode(column).alias("h")).distinct()
    for group in ([key, F.pmod("h", F.lit(256))], [key]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy("h"))
        rows = rows.withColumn("place", place).where(F.col("place") <= k).drop("place")
    return rows.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(column))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Exact below k, else (k - 1) / (the k-th smallest hash as a share of all values)."""
    share = (F.element_at(s, F.lit(k)).cast("double") + SPAN / 2) / SPAN
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def resemblance(left: Column, right: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all, from the sketch of the union."""
    union = merge(left, right, k)
    common = F.size(F.array_intersect(union, F.array_intersect(left, right)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def containment(left: Column, right: Column, k: int = K) -> Column:
    """Estimated share of the left one's shingles that the right one has, at most 1."""
    both = resemblance(left, right, k) * distinct_shingles(merge(left, right, k), k)
    mine = distinct_shingles(left, k)
    return F.when(mine == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / mine))


def as_text(s: Column) -> Column:
    """The sketch's 64-bit hashes, each as 16 hexadecimal digits."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def next_ids(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, next_id, need, several) for each distinct doc_id, in ascending order, in a circle.

    ``need`` is the most code points that any document of this id takes from the next one,
    ``several`` whether the next id has more than one row. The order is found in ranges:
    each range is ordered by itself, and only its first id is needed by the range before it.
    """
    half = F.floor(F.length(F.coalesce("text", F.lit(""))) / 2)
    ids = docs.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(half).alias("need"), F.count("*").alias("rows"))
    ids = scratch.keep(ids, "ids")
    ranged = scratch.keep(ids.repartitionByRange("id").withColumn(
        "part", F.spark_partition_id()), "ranged")
    one = F.struct("id", "rows")
    firsts = ranged.groupBy("part").agg(F.min(F.struct(F.col("id").isNotNull(), "id", "rows")).alias("f"))
    by_part = Window.partitionBy().orderBy("part")
    firsts = firsts.select("part", F.coalesce(
        F.lead("f").over(by_part), F.first("f").over(
            by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .alias("start"))
    in_part = Window.partitionBy("part").orderBy("id")
    linked = ranged.withColumn("within", F.lead(one).over(in_part)).join(firsts, "part")
    at_end = F.col("within").isNull()
    return linked.select(
        "id", "need", F.when(at_end, F.col("start.id")).otherwise(F.col("within.id")).alias("next_id"),
        (F.when(at_end, F.col("start.rows")).otherwise(F.col("within.rows")) > 1).alias("several"))


def edited(docs: DataFrame, scratch: Scratch, k: int = K) -> DataFrame:
    """Each document with its sketch, its edited text and the next document's sketch.

    The edited text keeps the first half (rounded up) and ends with as many code points of
    the next document, by ascending doc_id, as were cut off, or all it has. Rows that share
    a doc_id have the same next document: the next larger id, of whose rows the one with the
    smallest (length, text) counts. A null doc_id comes first. One document follows itself.
    """
    links = scratch.keep(next_ids(docs, scratch), "links")
    # the same two columns on both sides, so that one shuffle of the texts serves both joins
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    giver = links.select(F.col("next_id").alias("giver"), F.col("id").alias("taker"), "need",
                         "several")
    meet = own.join(giver, F.col("doc_id").eqNullSafe(F.col("giver")))

    def gifts(rows: DataFrame) -> DataFrame:
        return rows.select("taker", F.expr("left(text, int(need))").alias("start"),
                           sketch(F.col("text"), k).alias("next_sketch"))

    # what a document gives is cut to size and sketched before it is shuffled to its taker
    given = gifts(meet.where(~F.col("several")))
    if not links.where("several").isEmpty():
        least = meet.where("several").groupBy("giver").agg(
            F.min(F.struct(F.length("text").alias("n"), "text", "taker", "need")).alias("x")
        ).select("x.*")
        given = given.unionByName(gifts(least))
    both = own.join(given, F.col("doc_id").eqNullSafe(F.col("taker"))).withColumn(
        "n", F.length("text"))
    cut = F.floor(F.col("n") / 2).cast("int")
    new = F.concat(F.expr("left(text, int(n - floor(n / 2)))"), F.substring("start", F.lit(1), cut))
    return both.select("doc_id", "text", F.col("n").cast("bigint").alias("n_chars"),
                       sketch(F.col("text"), k).alias("sketch"), "next_sketch",
                       new.alias("edited"))
