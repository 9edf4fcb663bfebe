"""Writers."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_days(df: DataFrame, path: str, day: str, days: Sequence[dt.date] = ()) -> None:
    """Write ``df`` in partitions of its ``day``, replacing the days it holds and no others: a rerun doubles nothing.

    ``days``: the days the run stands for. Rows of other days are refused, and one of these days that has no rows any more
    loses its old ones. Only the distinct days of the run, as many as ``days`` at most, come to the driver.
    """
    spark = df.sparkSession
    if days:
        outside = F.raise_error(F.concat(F.lit(f"{day} outside the run: "), F.coalesce(F.col(day).cast("string"), F.lit("none"))))
        df = df.withColumn(day, F.when(F.col(day).isin(*days), F.col(day)).otherwise(outside.cast("date")))
    seen = Observation(f"days-{uuid.uuid4().hex}")
    if days:
        df = df.observe(seen, F.collect_set(day).alias("days"))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    for gone in sorted(set(days) - set(seen.get["days"])) if days else ():
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{day}={gone.isoformat()}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def expire_versions(table: str, folder: str, spark: SparkSession) -> int:
    """Delete the versions below ``folder`` that ``table`` no longer points at; how many were deleted.

    For a time when no reader holds an older version.
    """
    current = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"].rstrip("/").rsplit("/", 1)[-1]
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in system.listStatus(root) if s.getPath().getName().startswith("version-") and s.getPath().getName() != current]
    for path in old:
        system.delete(path, True)
    return len(old)


def full_refresh(df: DataFrame, table: str, folder: str) -> None:
    """Replace the content of the catalog table ``table``, in one step.

    The rows are written once, into a new version below ``folder``; then the table is pointed at it. Until that one
    catalog change the old version is what readers see, so a job that fails leaves it untouched, and a plan that reads
    ``table`` itself is safe. Older versions stay for readers that still hold them, until ``expire_versions``. A
    partitioned table is refused: its partitions would stay where they are.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and any(c.isPartition for c in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is partitioned")
    version = f"{folder.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(version)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=version, source="parquet")


def csv_export(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headered CSV. ``single_file`` is for small reports: all rows go through one task into one file."""
    report = df.coalesce(1) if single_file else df
    report.write.options(header=True, sep=",", quote='"', escape='"').mode("overwrite").csv(path)
