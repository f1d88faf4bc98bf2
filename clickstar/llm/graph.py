"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar.llm.tables import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): the smallest node of each component of ``edges(a, b)``.

    Every step points nodes at the smallest neighbour; a node of many edges is aggregated
    in part before the shuffle, and joins on it are split by adaptive execution. Each
    round is written, so a lost executor repeats one round at most; rounds grow with the
    logarithm of the longest path. Nodes without edges are not listed.
    """
    held = scratch.keep(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    turn, before = 0, None
    while True:
        state = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if turn:
            scratch.drop(f"{name}-{turn}-large", f"{name}-{turn - 1}")
        if state == before or state[0] == 0:
            return held.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).union(
                held.select("b", "b").distinct())
        before = state
        turn += 1
        both = held.union(held.select("b", "a")).toDF("node", "near")
        least = both.groupBy("node").agg(F.least("node", F.min("near")).alias("m"))
        large = both.where("near > node").join(least, "node").select(
            F.col("near").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = scratch.keep(large, f"{name}-{turn}-large")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        held = scratch.keep(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .union(down.select("a", "m")).where("a <> b").distinct(),
                            f"{name}-{turn}")
