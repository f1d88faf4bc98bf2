"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(app: str = "clickstar", cores: str | int = "*", partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", conf.pop("driver_memory", "8g")))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


# Settings for a large cluster, for spark-submit or the session builder. Shuffles start
# wide and adaptive execution merges small partitions up to the advisory size.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results and speed depend on.

    The JVM never compiles a method above 8,000 bytes of bytecode. A projection of
    many columns fused into one such method would be interpreted, several times
    slower than the same projection in smaller methods, so fusing stops there.

    Batches for Python are bounded by bytes too: 10,000 whole texts may take tens of megabytes,
    and a task holds its batches several times, in the JVM and in Python.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def prepare_wide(spark: SparkSession) -> SparkSession:
    """Also keeps the rows of one scanning task few, for plans that sort or buffer wide rows.

    A flat event takes about 25 bytes in a file and 500 to 1,000 in a sort, so the default split
    of 128 MB would make a task hold millions of rows and spill them: the spilled bytes
    then grow faster than the input. With small splits tables that grow make more tasks instead.

    Aggregates with sketches or sets hold 128 groups and sort all rows that follow; a day has
    some hundred tile rows, of a few kilobytes each, so they are let to hold 4,096.
    """
    prepare(spark).conf.set("spark.sql.files.maxPartitionBytes", "8m")
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
    return spark


LOCAL_DIR = "clickstar.local.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = spark.conf.get(LOCAL_DIR, None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set(LOCAL_DIR, folder)
    return folder


def side_by_side(spark: SparkSession, steps: Iterable[Callable[[], object]],
                 width: int = 4) -> list:
    """Runs independent Spark jobs at the same time, so small ones share the cluster."""
    with ThreadPoolExecutor(width) as pool:
        run = inheritable_thread_target(spark)
        return [f.result() for f in [pool.submit(run(step)) for step in steps]]
