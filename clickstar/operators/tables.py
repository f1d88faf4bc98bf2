"""Tables as folders of Parquet: replace, partition, create, retain, rewrite."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickstar.schemas import LAYERS, TABLES, Table


class CountMismatch(RuntimeError):
    """A rewritten table does not hold as many rows as its source."""


def write_replace(df: DataFrame, path: str) -> None:
    """Replaces the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def laid_out(df: DataFrame, partition: str, cluster: tuple[str, ...] = (),
             rebalance: bool = True) -> DataFrame:
    """Rows in the order files are written in.

    ``rebalance`` lets adaptive execution size the files of every day: small days
    end up in one file, large or skewed ones are split. A projection of files that
    already hold one day each needs no shuffle: pass ``rebalance=False``. Sorting
    by the cluster columns lets readers skip row groups by their min and max.
    """
    if rebalance:
        df = df.hint("rebalance", F.col(partition))
    return df.sortWithinPartitions(partition, *[c for c in cluster if c != partition])


def lookup_options(columns: tuple[str, ...]) -> dict[str, str]:
    """Writer options for Parquet bloom filters, sized by each row group's distinct values.

    A lookup of one value then skips the row groups that do not hold it, also where the
    value lies between their least and greatest one.
    """
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**options, "parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}


def write_partitioned(df: DataFrame, path: str, partition: str, cluster: tuple[str, ...] = (),
                      rebalance: bool = True, lookups: tuple[str, ...] = ()) -> None:
    """Replaces exactly the days present in ``df`` and leaves the others alone.

    New files are staged and moved in at commit, so tasks that run again after an
    executor is lost still find their input. ``lookups`` names columns of single-value lookups.
    """
    (laid_out(df, partition, cluster, rebalance).write.mode("overwrite")
     .options(**lookup_options(lookups)).option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def append_rows(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def mark(spark: SparkSession, path: str) -> None:
    """An empty folder."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def ensure_table(spark: SparkSession, path: str, schema: StructType,
                 partition: str | None = None) -> bool:
    """Creates an empty table of the declared schema unless one is there."""
    if exists(spark, path):
        return False
    empty = spark.createDataFrame([], schema)
    writer = empty.write.mode("ignore")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    return True


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def partition_days(spark: SparkSession, path: str, partition: str) -> list[dt.date]:
    """Days a table holds, from its folder names: no data is read."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(p))
    head = f"{partition}="
    return sorted(dt.date.fromisoformat(n[len(head):]) for n in names
                  if n.startswith(head) and n[len(head):len(head) + 1].isdigit())


def numbered_folders(spark: SparkSession, path: str, head: str) -> list[int]:
    """N of the folders ``head=N`` under a path."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(int(n[len(head) + 1:]) for n in names
                  if n.startswith(f"{head}=") and n[len(head) + 1:].isdigit())


def retention_cutoff(as_of: dt.date, years: int) -> dt.date:
    """The same day ``years`` earlier; 29 February falls back to the 28th."""
    try:
        return as_of.replace(year=as_of.year - years)
    except ValueError:
        return as_of.replace(year=as_of.year - years, day=28)


def survivors(table: DataFrame, column: str, cutoff: dt.date) -> DataFrame:
    """Rows that a delete before ``cutoff`` leaves: a NULL date is not before it."""
    return table.where((F.col(column) >= F.lit(cutoff)) | F.col(column).isNull())


def delete_before(spark: SparkSession, path: str, partition: str, cutoff: dt.date) -> int:
    """Drops whole days older than ``cutoff``; returns how many."""
    fs, _ = _fs(spark, path)
    old = [d for d in partition_days(spark, path, partition) if d < cutoff]
    for day in old:
        fs.delete(_fs(spark, f"{path}/{partition}={day}")[1], True)
    spark.catalog.refreshByPath(path)
    return len(old)


def rewrite(spark: SparkSession, source: str, target: str, partition: str,
            cluster: tuple[str, ...]) -> int:
    """Writes a table anew in another order and checks the row count."""
    rows = spark.read.parquet(source)
    (laid_out(rows, partition, cluster).write.mode("errorifexists")
     .partitionBy(partition).parquet(target))
    before, after = rows.count(), spark.read.parquet(target).count()
    if before != after:
        raise CountMismatch(f"{source} has {before} rows, {target} has {after}")
    return after


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder, such as the staged input of a finished step."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
    spark.catalog.refreshByPath(path)


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Puts the folder ``new`` in place of ``path``; the version before stays as ``.old``.

    Both moves are renames, so a crash leaves the old version, the new one, or both.
    """
    fs, here = _fs(spark, path)
    old = _fs(spark, f"{path}.old")[1]
    if fs.exists(here):
        fs.delete(old, True)
        if not fs.rename(here, old):
            raise RuntimeError(f"could not set {path} aside")
    if not fs.rename(_fs(spark, new)[1], here):
        raise RuntimeError(f"could not move {new} to {path}")
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> bool:
    """Brings the old version back when a swap stopped between its two moves."""
    fs, here = _fs(spark, path)
    old = _fs(spark, f"{path}.old")[1]
    if fs.exists(here) or not fs.exists(old):
        return False
    return fs.rename(old, here)


def replace_safely(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replaces a whole table by writing the new version beside it and swapping it in.

    Readers and a crash in between find the old version or the new one.
    """
    spark, new = df.sparkSession, f"{path}.new"
    recover(spark, path)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(new)
    swap_in(spark, new, path)


def stage_days(df: DataFrame, path: str, partition: str, cluster: tuple[str, ...]) -> None:
    """Writes new versions of some days beside the table, for :func:`swap_days`."""
    (laid_out(df, partition, cluster).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(partition)
     .parquet(f"{path}.staged"))


def swap_days(spark: SparkSession, path: str) -> int:
    """Moves every staged day in place of the table's; returns how many.

    A day's old folder is set aside, the new one moved in, each by one rename, and the old
    folders go at the end. Stopped at any point it can be called again: a stage that was
    not finished is dropped, a finished one is moved in to the last day.
    """
    fs, staged = _fs(spark, f"{path}.staged")
    aside = _fs(spark, f"{path}.aside")[1]
    if not fs.exists(staged):
        fs.delete(aside, True)
        return 0
    if not fs.exists(_fs(spark, f"{path}.staged/_SUCCESS")[1]):
        fs.delete(staged, True)
        return 0
    fs.mkdirs(aside)
    fs.mkdirs(_fs(spark, path)[1])
    names = [status.getPath().getName() for status in fs.listStatus(staged)
             if status.isDirectory()]
    for name in names:
        here, old = (_fs(spark, f"{folder}/{name}")[1] for folder in (path, f"{path}.aside"))
        if fs.exists(here):
            fs.delete(old, True)
            if not fs.rename(here, old):
                raise RuntimeError(f"could not set {name} of {path} aside")
        if not fs.rename(_fs(spark, f"{path}.staged/{name}")[1], here):
            raise RuntimeError(f"could not move {name} to {path}")
    fs.delete(staged, True)
    fs.delete(aside, True)
    spark.catalog.refreshByPath(path)
    return len(names)


def recluster(spark: SparkSession, path: str, partition: str, cluster: tuple[str, ...]) -> int:
    """Rewrites a table in a new order and swaps it in; the old one stays as ``.old``."""
    rows = rewrite(spark, path, f"{path}.new", partition, cluster)
    swap_in(spark, f"{path}.new", path)
    return rows


def backup_and_migrate(spark: SparkSession, path: str, partition: str,
                       cluster: tuple[str, ...], version: int) -> str:
    """Keeps ``path`` as it is and writes version ``version`` beside it."""
    target = f"{path}_v{version}"
    rewrite(spark, path, target, partition, cluster)
    return target


def create_layers(spark: SparkSession, root: str) -> list[str]:
    """One schema and one folder per layer."""
    for layer in LAYERS:
        fs, p = _fs(spark, f"{root}/{layer}")
        fs.mkdirs(p)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")
    return list(LAYERS)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def catalogue(spark: SparkSession, path: str, table: Table) -> str:
    """Registers a written table with its description."""
    name = f"{table.layer}.{table.name}"
    spark.catalog.dropTempView(table.name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet", description=table.description)
    if table.partition:
        spark.catalog.recoverPartitions(name)
    spark.sql(f"COMMENT ON TABLE {name} IS {json.dumps(table.description)}")
    return name


def table_layout(spark: SparkSession, name: str) -> DataFrame:
    """Cluster columns of a table with their position."""
    columns = TABLES[name].cluster
    return spark.createDataFrame(
        [(name, i, c) for i, c in enumerate(columns, 1)],
        "table_name string, clustering_ordinal_position int, column_name string")
