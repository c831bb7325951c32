"""Helpers shared by all operators: reading tables and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or in local mode, where it is unset, a temporary one."""
    if there := spark.conf.get("spark.checkpoint.dir", None):
        return there.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; on a cluster it must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomset-"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared folder: a reliable checkpoint that survives the loss of executors."""
    shared_dir(df.sparkSession)
    if not df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: smaller than a checkpoint where rows are wide. ``parts`` name the columns it is divided by."""
    path = f"{shared_dir(df.sparkSession)}/loomset-{uuid.uuid4().hex}"
    df.write.partitionBy(*parts).parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # an empty table with parts has no file to tell its schema


def unbroadcast(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that sorts both sides and broadcasts neither. For rows that Spark takes for far fewer than they are, such as exploded
    ones: it would collect many times its limit of a broadcast in the driver."""
    return df.hint("merge")


T = TypeVar("T")


def together(*work: Callable[[], T], most: int = 2) -> list[T]:
    """The results of ``work``, whose Spark jobs run side by side, so that small ones don't wait for each other; ``most`` at a time."""
    with ThreadPoolExecutor(max_workers=most) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(SparkSession.active())(w)) for w in work]]


def ranked(df: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with the 0-based rank ``name`` of each row in its group of ``within``, by ``order``. No group meets in one task: rows are ranked within
    ranges of the order, and what the ranges before hold is added."""
    cut_ = written(df.repartitionByRange(*within, *order).withColumn("_range", F.spark_partition_id()))
    own = Window.partitionBy("_range", *within).orderBy(*order)
    x = cut_.withColumn("_at", F.row_number().over(own) - 1)
    size = cut_.groupBy("_range", *within).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    size = size.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(within)})
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(within)]
    x = x.join(size.withColumnRenamed("_range", "_r"), reduce(Column.__and__, same, F.col("_range") == F.col("_r")))
    return x.select(*df.columns, (F.col("_before") + F.col("_at")).alias(name))


def hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def folder(spark: SparkSession) -> str:
    """A new folder in the shared one, for tables that are added to; ``clear`` deletes it."""
    _written.append(f"{shared_dir(spark)}/loomset-{uuid.uuid4().hex}")
    return _written[-1]


_written: list[str] = []
_forget: list[Callable[[], None]] = []


def on_clear(*forget: Callable[[], None]) -> None:
    """Has ``clear`` call ``forget`` too, where something is kept that reads the tables it deletes."""
    _forget.extend(forget)


def clear(spark: SparkSession) -> int:
    """Deletes the tables that ``written`` has left in the shared folder, once nothing reads them any more; gives their number."""
    for forget in _forget:
        forget()
    n = len(_written)
    while _written:
        fs, path = hadoop(spark, _written.pop())
        fs.delete(path, True)
    return n
