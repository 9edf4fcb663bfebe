"""Readers for the inputs the reports use."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Format of the control-character drops.
CONTROL_CSV = {"sep": "\u0002", "lineSep": "\u0001", "header": "true", "nullValue": "NULL"}


def read_control_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """Several drops in one read; without a schema the types are inferred, which reads the data twice."""
    reader = spark.read.options(**CONTROL_CSV)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def period_from_path(pattern: str) -> Column:
    """The first group of ``pattern`` in the path of the file a row came from."""
    return F.regexp_extract(F.input_file_name(), pattern, 1)


def on_days(df: DataFrame, column: str, first: dt.date, days: int = 1) -> DataFrame:
    """Rows of ``days`` days from ``first`` on.

    Compares the bare column, so a date partition is pruned and a Parquet date or timestamp is pushed down.
    """
    last = first + dt.timedelta(days=days)
    return df.where((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(last)))


def typed_landing(df: DataFrame, columns: dict[str, tuple[Column, str]], required: Sequence[str] = (), strict: Sequence[str] = ()) -> DataFrame:
    """Project into declared types: a bad value is NULL, in ``strict`` columns an error; ``required`` may not be NULL."""
    out = []
    for name, (value, kind) in columns.items():
        typed = value.cast(kind) if name in strict else value.try_cast(kind)
        if name in required:
            typed = F.coalesce(typed, F.raise_error(F.lit(f"{name} is missing")).cast(kind))
        out.append(typed.alias(name))
    return df.select(*out)


def read_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Nested documents exported as JSON lines; a document-store connector returns the same shape."""
    return spark.read.schema(schema).json(path)


def first_candidate(df: DataFrame, candidates: str, name: str) -> DataFrame:
    """Element 0 of an array column in place of the array; NULL when it is empty."""
    return df.withColumn(name, F.get(F.col(candidates), 0)).drop(candidates)
