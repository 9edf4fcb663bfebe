"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime settings only; partition counts and memory belong to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # text lists are short and their groups many; the default of 128 sorts almost every time
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.session.timeZone": "UTC",
}


# What one task reads of an exchange. A stage of several joins and aggregates holds a multiple of that, unpacked, for each of
# them, so the default of 64 MB makes gigabytes a task.
TASK_INPUT = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to the session, for good, and ``TASK_INPUT`` where the session names none. The registered queries do
    so; jobs in a deployment leave them to it.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    key, value = TASK_INPUT
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees: ``spark.checkpoint.dir``, or the context's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


_owner: ContextVar[RunTables | None] = ContextVar("owner", default=None)


class RunTables:
    """Owner of the tables a run writes: ``with RunTables(spark, folder): …`` puts every cut of the block into one folder
    and deletes it at the end. Results must be written elsewhere inside the block.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{(folder or shared_dir(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"

    def __enter__(self) -> RunTables:
        self._token = _owner.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _owner.reset(self._token)
        self.delete()

    def delete(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` cached inside the block and released after it."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no earlier run has used, in the folder of the run's owner where there is one."""
    owner = _owner.get()
    root = owner.path if owner else f"{shared_dir(spark)}/billscope"
    return f"{root}-{uuid.uuid4().hex}/{name}" if not owner else f"{root}/{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, readable after the loss of any executor.

    Unlike a checkpointed frame it is columnar, so each later use reads only its columns and knows its size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, name: str = "step", **counts: Column) -> tuple[DataFrame, dict[str, object]]:
    """``cut``, and aggregates of its rows (``n``: their number) that the write computes as it goes, without a pass of its own."""
    seen = Observation(name)
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n"), *[value.alias(key) for key, value in counts.items()]), name)
    return out, seen.get


@cache
def bucket_numbers(spark: SparkSession, buckets: int) -> np.ndarray:
    """For each bucket of a table with that many the smallest number whose hash puts it there."""
    tried = spark.range(0, int(buckets * (math.log(buckets) + 10))).select("id", F.pmod(F.hash("id"), F.lit(buckets)).alias("b"))
    found = {row["b"]: row["id"] for row in tried.groupBy("b").agg(F.min("id").alias("id")).collect()}
    return np.array([found.get(b, 0) for b in range(buckets)], dtype=np.int64)


def cut_buckets(df: DataFrame, parts: int, part: str, name: str) -> DataFrame:
    """The partitions of ``df``, ``parts`` at most, as the buckets of a table in the shared folder, with their number as ``part``.

    Like ``cut``, but a window or join on ``_bucket`` and further columns reads the buckets without another exchange. The
    catalog entry goes again at once; the files stay with the run like those of ``cut``.
    """
    spark = df.sparkSession
    number = F.element_at(F.lit(bucket_numbers(spark, parts)), F.pmod(F.col(part), F.lit(parts)) + 1)
    placed = df.withColumn(part, F.spark_partition_id()).withColumn("_bucket", number)
    table = f"billscope_{name}_{uuid.uuid4().hex}"
    placed.write.format("parquet").bucketBy(parts, "_bucket").option("path", scratch_path(spark, name)).saveAsTable(table)
    read = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # of a table with its own path only the entry
    return read


def spread(df: DataFrame) -> DataFrame:
    """``df`` on as many partitions as the session has cores, where its files give fewer; else as it is.

    For work that is heavy per row over a small input, whose few row groups would keep most cores idle. Large inputs have more
    splits than cores and are not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
