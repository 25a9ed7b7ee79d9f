"""Session defaults and durable intermediate results."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Noting the caller of every column expression costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. Conf keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where a cluster does not name one, the warehouse folder serves. Only a local master may fall
    back to the warehouse on the local disk, because driver and executors are one process there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    # A path without a scheme lies in the default file system, which on a cluster is a shared one.
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    local_disk = (warehouse if ":" in warehouse.split("/")[0] else default).startswith("file:")
    if local_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{warehouse}/_checkpoints"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


_made: list[str] = []


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the durable root. ``discard`` deletes it."""
    path = f"{durable_root(spark)}/marketloom-{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def stored(df: DataFrame, label: str = "table", **options: str) -> DataFrame:
    """Evaluate once and keep the rows as Parquet on shared storage, so that a lost executor changes nothing.

    Needed wherever a value is tied to where a row happened to lie (its place in a sort) or where one result
    feeds several later passes. These read only the columns they need, and the optimizer knows the size of what it
    joins. ``options`` are the writer's.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many intermediate folders there are so far, for ``discard``."""
    return len(_made)


def discard(spark: SparkSession, since: int = 0) -> None:
    """Delete the intermediate folders made after ``since``. What still reads them must be done."""
    while len(_made) > since:
        files, path = file_system(spark, _made.pop())
        files.delete(path, True)


def _discard_at_exit() -> None:
    if SparkContext._active_spark_context is not None:
        discard(SparkSession.builder.getOrCreate())


atexit.register(_discard_at_exit)


def run_at_once(job: Callable, inputs: Iterable, at_once: int = 4) -> list:
    """Submit independent Spark jobs from a few driver threads; results in input order."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(job, inputs))
