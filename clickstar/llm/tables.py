"""Reading the supplied tables and writing intermediate ones."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a supplied table; others stay unread."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors once, for the operators that run Python there."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="clickstar-"), "clickstar_package.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
    return spark


class Scratch:
    """Tables written once under the shared folder, so that a lost executor costs no rework."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Frees tables that nothing reads any more: all that was made of them is written."""
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self) -> None:
        """Frees all of its tables."""
        self.drop("")


def lower_ascii(text: Column) -> Column:
    """A-Z only; for short strings, as ``translate`` works letter by letter."""
    return F.translate(text, UPPER, LOWER)
