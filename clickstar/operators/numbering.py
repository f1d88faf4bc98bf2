"""Row numbers within groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000
QUARTER_HOUR = 15 * 60 * SECOND


def number_rows(rows: DataFrame, group: list[str], name: str, clock: str = "event_timestamp",
                tie: str = "src_event_id", slot_micros: int = QUARTER_HOUR,
                before: DataFrame | None = None) -> DataFrame:
    """Consecutive numbers from 1 per group, ordered by (clock, tie).

    A plain window would sort one whole group in one task. Here a group is cut
    into time slots: slots are counted with partial aggregation, the counts give
    each slot its starting number, and only the rows of one slot are sorted
    together. NULL group values form a group of their own and a NULL clock sorts
    first. Group columns are made non-NULL so that join and window share one
    shuffle. A group with a NULL in it gathers all rows of unknown users, so it is
    cut into slots of a second; numbers do not depend on the slots' length. Numbers go on
    from ``before`` (group columns, rows) where it is given: it counts as one slot before all.
    """
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in group])
    fine = F.expr(f"{clock} div {SECOND}")
    coarse = F.expr(f"{clock} div {slot_micros}")
    slot = F.coalesce(F.when(unknown, fine).otherwise(coarse), F.lit(-(2 ** 62)))
    spread, filled = [], {}
    for i, column in enumerate(group):
        filled |= {f"_g{i}": F.coalesce(F.col(column).cast("string"), F.lit("")),
                   f"_n{i}": F.col(column).isNull()}
        spread += [f"_g{i}", f"_n{i}"]
    sized = rows.withColumns(filled).withColumn("_slot", slot)
    counts = sized.groupBy(*spread, "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    if before is not None:
        counts = counts.unionByName(before.withColumns(filled).select(
            *spread, F.lit(-(2 ** 62) - 1).alias("_slot"), F.col("rows").alias("_rows")))
    earlier = (Window.partitionBy(*spread).orderBy("_slot")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*spread, "_slot",
                            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*spread, "_slot").orderBy(clock, tie)
    return (sized.join(offsets, [*spread, "_slot"])
            .withColumn(name, F.row_number().over(within).cast("bigint") + F.col("_before"))
            .drop(*spread, "_slot", "_before"))
