"""Upsert on Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickstar.operators import tables
from clickstar.schemas import Table


TWICE = "several source rows share one merge key"


class DuplicateMergeKey(ValueError):
    """Several source rows would update one target row."""


def _matches(keys: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys]
    return reduce(lambda a, b: a & b,
                  [t.eqNullSafe(s) if null_safe else t == s for t, s in pairs])


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str],
               update_columns: list[str] | None = None, null_safe: bool = True,
               repeats: bool = False) -> DataFrame:
    """The table after the merge.

    A matched row takes ``update_columns`` from the source (all columns when not
    given) and keeps the rest; an unmatched source row is inserted whole; an
    unmatched target row stays. With ``null_safe`` a NULL key equals a NULL key,
    so a second run of the same load changes nothing; otherwise a row with a NULL
    key matches nothing.

    Both sides are stacked and sorted by key with the source row first, so rows are shuffled
    once, and every target row stays, also where several share a key: the window hands them
    the source row and buffers no group. Two source rows of one key stop the job, or with
    ``repeats`` count as one, for sources that may deliver a row again.
    """
    columns = target.columns
    update = set(columns if update_columns is None else update_columns) - set(keys)
    both = target.withColumn("_new", F.lit(False)).unionByName(
        source.select(*columns).withColumn("_new", F.lit(True)))
    group = list(keys)
    if not null_safe:
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        both = both.withColumn("_alone", F.when(no_key, F.monotonically_increasing_id()))
        group.append("_alone")
    by_key = Window.partitionBy(*group).orderBy(F.desc("_new"))
    packed = F.struct(F.lit(True).alias("_"), *[c for c in columns if c in update])
    seen = both.withColumns({
        "_s": F.first(F.when(F.col("_new"), packed)).over(
            by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next_new": F.lead("_new").over(by_key)})
    twice = F.concat(F.lit(f"{TWICE} {', '.join(keys)}: "),
                     F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    # a source row stays where no target row follows it
    stays = F.when(~F.col("_new") | F.col("_next_new").isNull(), True)
    if not repeats:
        stays = stays.when(F.col("_next_new"), F.raise_error(twice).cast("boolean"))
    stays = stays.otherwise(False)

    def value(c: str) -> Column:
        if c not in update:
            return F.col(c)
        return F.when(~F.col("_new") & F.col("_s").isNotNull(), F.col(f"_s.{c}")).otherwise(F.col(c))

    return seen.where(stays).select(*[value(c).alias(c) for c in columns])


def incremental_merge(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Merge on one key that updates and inserts every column."""
    return merge_rows(target, source, [key], null_safe=False)


def touched_days(target: DataFrame, source: DataFrame, table: Table) -> list:
    """Partitions the merge can change: one value per day, never one per row.

    Days of the source, and where the day is no part of the key also the days of
    the target rows it matches, since a matched row stays in its partition.
    """
    day = table.partition
    days = source.select(day).distinct()
    if day not in table.merge_keys:
        hit = (target.select(day, *table.merge_keys).alias("t")
               .join(source.select(*table.merge_keys).alias("s"),
                     _matches(list(table.merge_keys), True), "left_semi"))
        days = days.unionByName(hit.select(day)).distinct()
    return [r[0] for r in days.collect()]


def merge_table(spark: SparkSession, path: str, source: DataFrame, table: Table,
                repeats: bool = False) -> int:
    """Merges ``source`` into the table at ``path``; rewrites touched days only.

    Returns the number of touched days. New versions of the days are written beside the
    table and swapped in day by day, after which no crash can lose a row; a swap that an
    earlier run left unfinished is finished first. ``source`` is read twice: pass a
    written table.
    """
    tables.swap_days(spark, path)
    tables.ensure_table(spark, path, table.schema, table.partition)
    target = tables.read_table(spark, path, table.schema)
    days = touched_days(target, source, table)
    if not days:
        return 0
    day = F.col(table.partition)
    inside = day.isin([d for d in days if d is not None])
    if None in days:
        inside = inside | day.isNull()
    merged = merge_rows(target.where(inside), source, list(table.merge_keys),
                        list(table.update_columns), repeats=repeats)
    try:
        tables.stage_days(merged, path, table.partition, table.cluster)
    except Exception as error:
        if TWICE in str(error):
            raise DuplicateMergeKey(str(error)[str(error).index(TWICE):][:300]) from error
        raise
    tables.swap_days(spark, path)
    return len(days)
